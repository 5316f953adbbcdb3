"""Property graph: vertices and edges with string-map properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio
from ledgerline.operators.grouping import assign_part, dedupe, group_parts, replicate, with_parts

# The vertex and edge types of the model.
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")
VERTEX_KEY = ("identifier", "type")
EDGE_KEY = ("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type")


def properties(**entries: Column) -> Column:
    """String map built by name; null values stay in the map."""
    parts: list[Column] = []
    for name, value in entries.items():
        parts += [F.lit(name), value.cast("string")]
    return F.create_map(*parts)


def properties_json(column: Column) -> Column:
    """The map as JSON text, null values kept."""
    return F.to_json(column, {"ignoreNullFields": "false"})


def vertex(df: DataFrame, kind: str, identifier: Column, props: Column) -> DataFrame:
    return df.select(
        identifier.cast("long").alias("identifier"), F.lit(kind).alias("type"), props.alias("properties")
    )


def edge(
    df: DataFrame, subject: Column, subject_type: str, obj: Column, object_type: str, kind: Column, props: Column
) -> DataFrame:
    return df.select(
        subject.cast("long").alias("subject_identifier"),
        F.lit(subject_type).alias("subject_type"),
        obj.cast("long").alias("object_identifier"),
        F.lit(object_type).alias("object_type"),
        kind.alias("edge_type"),
        props.alias("properties"),
    )


def game_vertices(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    props = properties(pts_home=F.col("pts_home"), pts_away=F.col("pts_away"), winning_team=winner)
    return vertex(games, "game", F.col("game_id"), props)


def player_vertices(details: DataFrame) -> DataFrame:
    """One vertex per player; rows are added up per team first, so the team list holds each team once."""
    per_team = details.groupBy("player_id", "team_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
    )
    totals = per_team.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.sum("number_of_games").alias("number_of_games"),
        F.sum("total_points").alias("total_points"),
        F.array_join(F.sort_array(F.collect_list("team_id")).cast("array<string>"), ",").alias("teams"),
    )
    names = ("player_name", "number_of_games", "total_points", "teams")
    return vertex(totals, "player", F.col("player_id"), properties(**{n: F.col(n) for n in names}))


def team_vertices(teams: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One vertex per team from a table that repeats teams."""
    one = dedupe(teams, ["team_id"], order)
    props = properties(
        abbreviation=F.col("abbreviation"),
        nickname=F.col("nickname"),
        city=F.col("city"),
        arena=F.col("arena"),
        year_founded=F.col("yearfounded"),
    )
    return vertex(one, "team", F.col("team_id"), props)


def count_by_type(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def plays_in(appearances: DataFrame) -> DataFrame:
    """Player to game edges from rows already unique on (player, game)."""
    names = ("start_position", "pts", "team_id", "team_abbreviation")
    return edge(
        appearances,
        F.col("player_id"),
        "player",
        F.col("game_id"),
        "game",
        F.lit("plays_in"),
        properties(**{n: F.col(n) for n in names}),
    )


def player_pairs(appearances: DataFrame, max_roster: int = 2_000) -> DataFrame:
    """Games and points of every two players who met, larger id as subject.

    ``appearances`` is unique on (player, game). The result itself has a row
    for every two players who ever met, so the pairs are the answer, not a
    by-product; they are summed up on the map side before the second shuffle.
    A game with more than ``max_roster`` rows is cut into parts: its objects
    are hashed over the parts and its subjects repeated once per part, so no
    task joins a whole oversized game with itself.
    """
    rows = appearances.select("player_id", "game_id", "team_id", "pts")
    sized = with_parts(rows, group_parts(rows, ["game_id"], max_roster), ["game_id"])
    subjects = replicate(sized).alias("a")
    objects = assign_part(sized, ["player_id"]).alias("b")
    met = (
        (F.col("a.game_id") == F.col("b.game_id"))
        & (F.col("a.part") == F.col("b.part"))
        & (F.col("a.player_id") > F.col("b.player_id"))
    )
    kind = F.when(F.col("a.team_id") == F.col("b.team_id"), "shares_team").otherwise("plays_against")
    return (
        subjects.join(objects, met)
        .groupBy(
            F.col("a.player_id").alias("subject_id"),
            F.col("b.player_id").alias("object_id"),
            kind.alias("edge_type"),
        )
        .agg(
            F.count(F.lit(1)).alias("num_games"),
            F.sum("a.pts").alias("subject_points"),
            F.sum("b.pts").alias("object_points"),
        )
    )


def pair_edges(pairs: DataFrame) -> DataFrame:
    names = ("num_games", "subject_points", "object_points")
    return edge(
        pairs,
        F.col("subject_id"),
        "player",
        F.col("object_id"),
        "player",
        F.col("edge_type"),
        properties(**{n: F.col(n) for n in names}),
    )


def plays_on(appearances: DataFrame) -> DataFrame:
    """Player to team edges with first and last season and games played."""
    spans = appearances.groupBy("player_id", "team_id").agg(
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count(F.lit(1)).alias("games"),
    )
    names = ("first_season", "last_season", "games")
    return edge(
        spans,
        F.col("player_id"),
        "player",
        F.col("team_id"),
        "team",
        F.lit("plays_on"),
        properties(**{n: F.col(n) for n in names}),
    )


def max_edge_property(vertices: DataFrame, edges: DataFrame, label: str, prop: str, name: str) -> DataFrame:
    """Largest numeric edge property per subject vertex, with a vertex property as label.

    Edges are reduced to one row per subject before the join, so a subject
    with very many edges costs the join nothing.
    """
    top = edges.groupBy("subject_identifier", "subject_type").agg(
        F.max(F.try_element_at("properties", F.lit(prop)).try_cast("double")).alias(name)
    )
    v = vertices.select("identifier", "type", F.try_element_at("properties", F.lit(label)).alias(label))
    return v.join(
        top, (v["identifier"] == top["subject_identifier"]) & (v["type"] == top["subject_type"])
    ).select("identifier", label, name)


def pair_with_career(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Player pair edges with the subject's points per game over the whole career.

    What the result needs is read from the maps before the join, so the join moves numbers only.
    """

    def number(name: str) -> Column:
        return F.col("properties")[name].try_cast("long")

    players = vertices.filter(F.col("type") == "player").select(
        F.col("identifier").alias("subject_identifier"),
        F.col("properties")["player_name"].alias("subject"),
        ratio(number("total_points"), number("number_of_games")).alias("career_average"),
    )
    pairs = edges.filter((F.col("subject_type") == "player") & (F.col("object_type") == "player")).select(
        "subject_identifier",
        "object_identifier",
        "edge_type",
        number("subject_points").alias("total_points"),
        number("num_games").alias("num_games"),
    )
    return pairs.join(players, "subject_identifier").select(
        "subject_identifier", "subject", "object_identifier", "edge_type", "career_average", "total_points", "num_games"
    )
