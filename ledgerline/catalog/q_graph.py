"""Vertices and edges."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import DETAIL_COLUMNS, PICK, first_row, using
from ledgerline.operators import graph
from ledgerline.operators.grouping import dealt
from ledgerline.operators.patterns import appearances, one_per_game
from ledgerline.sources import files, schemas

TEAM_COLUMNS = ("team_id", "abbreviation", "nickname", "city", "arena", "yearfounded")
ONE_TEAM = first_row("teams", ["team_id"], TEAM_COLUMNS)
ONE_APPEARANCE = first_row("game_details", ["player_id", "game_id"], DETAIL_COLUMNS, PICK)


def prop(name: str) -> Column:
    return F.try_element_at("properties", F.lit(name)).alias(name)


def vertex_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select("identifier", "type", *[prop(n) for n in names])


def edge_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select("subject_identifier", "object_identifier", "edge_type", *[prop(n) for n in names])


def one_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_game(views.game_details(spark, sf_dir, by_game=True))


def player_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.player_vertices(views.game_details(spark, sf_dir))


@query(
    "g1_game_vertices",
    using(
        """SELECT game_id AS identifier, 'game' AS type,
        '{"pts_home":"' || pts_home || '","pts_away":"' || pts_away || '","winning_team":"'
          || CASE WHEN home_team_wins = 1 THEN home_team_id ELSE visitor_team_id END || '"}' AS properties
        FROM games""",
        "games",
    ),
)
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = graph.game_vertices(views.games(spark, sf_dir))
    return vertices.withColumn("properties", graph.properties_json(F.col("properties")))


@query(
    "g2_player_vertices",
    using(
        """SELECT identifier, 'player' AS type, player_name, CAST(n AS VARCHAR) AS number_of_games,
        CAST(points AS VARCHAR) AS total_points, array_to_string(list_sort(teams), ',') AS teams
        FROM (SELECT player_id AS identifier, max(player_name) AS player_name, count(*) AS n, sum(pts) AS points,
                     list(DISTINCT team_id) AS teams FROM game_details GROUP BY 1)""",
        "game_details",
    ),
)
def g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertex_columns(
        player_vertices(spark, sf_dir), "player_name", "number_of_games", "total_points", "teams"
    )


@query(
    "g3_team_vertices",
    using(
        f"""SELECT team_id AS identifier, 'team' AS type, abbreviation, nickname, city, arena,
        CAST(yearfounded AS VARCHAR) AS year_founded FROM ({ONE_TEAM})""",
        "teams",
    ),
)
def g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = graph.team_vertices(views.teams(spark, sf_dir))
    return vertex_columns(vertices, "abbreviation", "nickname", "city", "arena", "year_founded")


@query(
    "g4_vertex_counts",
    using(
        """SELECT 'game' AS type, count(DISTINCT game_id) AS n FROM games
        UNION ALL SELECT 'player', count(DISTINCT player_id) FROM game_details
        UNION ALL SELECT 'team', count(DISTINCT team_id) FROM teams""",
        "games",
        "game_details",
        "teams",
    ),
)
def g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        graph.game_vertices(views.games(spark, sf_dir)),
        player_vertices(spark, sf_dir),
        graph.team_vertices(views.teams(spark, sf_dir)),
    ]
    return graph.count_by_type(reduce(DataFrame.unionByName, parts))


@query(
    "g5_plays_in",
    using(
        f"""SELECT player_id AS subject_identifier, game_id AS object_identifier, 'plays_in' AS edge_type,
        start_position, CAST(pts AS VARCHAR) AS pts, CAST(team_id AS VARCHAR) AS team_id, team_abbreviation
        FROM ({ONE_APPEARANCE})""",
        "game_details",
    ),
)
def g5(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.plays_in(one_appearance(spark, sf_dir))
    return edge_columns(edges, "start_position", "pts", "team_id", "team_abbreviation")


PAIRS = f"""SELECT a.player_id AS subject_identifier, b.player_id AS object_identifier,
        CASE WHEN a.team_id = b.team_id THEN 'shares_team' ELSE 'plays_against' END AS edge_type,
        count(*) AS num_games, sum(a.pts) AS subject_points, sum(b.pts) AS object_points
        FROM ({ONE_APPEARANCE}) a JOIN ({ONE_APPEARANCE}) b ON a.game_id = b.game_id AND a.player_id > b.player_id
        GROUP BY 1, 2, 3"""


@query(
    "g6_player_pairs",
    using(
        f"""SELECT subject_identifier, object_identifier, edge_type, CAST(num_games AS VARCHAR) AS num_games,
        CAST(subject_points AS VARCHAR) AS subject_points, CAST(object_points AS VARCHAR) AS object_points FROM ({PAIRS})""",
        "game_details",
    ),
)
def g6(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.pair_edges(graph.player_pairs(one_appearance(spark, sf_dir)))
    return edge_columns(edges, "num_games", "subject_points", "object_points")


@query(
    "g7_max_points",
    using(
        f"""SELECT player_id AS identifier, player_name, CAST(max(pts) AS DOUBLE) AS max_points
        FROM ({ONE_APPEARANCE}) GROUP BY 1, 2""",
        "game_details",
    ),
)
def g7(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.plays_in(one_appearance(spark, sf_dir))
    found = graph.max_edge_property(player_vertices(spark, sf_dir), edges, "player_name", "pts", "max_points")
    return found.orderBy(F.col("max_points").desc_nulls_first(), "identifier")


@query(
    "g8_pair_vs_career",
    using(
        f"""SELECT subject_identifier, 'P' || subject_identifier AS subject, object_identifier, edge_type,
        round(c.career_average, 6) AS career_average, CAST(subject_points AS BIGINT) AS total_points, num_games
        FROM ({PAIRS}) p JOIN (SELECT player_id, CAST(sum(pts) AS DOUBLE) / count(*) AS career_average
                               FROM game_details GROUP BY 1) c ON c.player_id = p.subject_identifier""",
        "game_details",
    ),
)
def g8(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.pair_edges(graph.player_pairs(one_appearance(spark, sf_dir)))
    return graph.pair_with_career(player_vertices(spark, sf_dir), edges)


@query(
    "g9_plays_on",
    using(
        """SELECT player_id AS subject_identifier, team_id AS object_identifier, 'plays_on' AS edge_type,
        CAST(min(season) AS VARCHAR) AS first_season, CAST(max(season) AS VARCHAR) AS last_season,
        CAST(count(*) AS VARCHAR) AS games FROM appearances GROUP BY 1, 2""",
        "appearances",
    ),
)
def g9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = appearances(views.game_details(spark, sf_dir, by_game=True), views.games(spark, sf_dir))
    return edge_columns(graph.plays_on(rows), "first_season", "last_season", "games")


@query(
    "g10_graph_tables",
    using(
        f""", pairs AS (SELECT DISTINCT a.player_id, b.player_id, CASE WHEN a.team_id = b.team_id THEN 'shares_team' ELSE 'plays_against' END AS kind
            FROM ({ONE_APPEARANCE}) a JOIN ({ONE_APPEARANCE}) b ON a.game_id = b.game_id AND a.player_id > b.player_id)
        SELECT 'vertices' AS of, 'game' AS type, count(DISTINCT game_id) AS n_rows, 0::BIGINT AS n_repeated_keys FROM games
        UNION ALL SELECT 'vertices', 'player', count(DISTINCT player_id), 0 FROM game_details
        UNION ALL SELECT 'vertices', 'team', count(DISTINCT team_id), 0 FROM teams
        UNION ALL SELECT 'edges', 'plays_in', count(DISTINCT (player_id, game_id)), 0 FROM game_details
        UNION ALL SELECT 'edges', 'plays_on', count(DISTINCT (player_id, team_id)), 0 FROM appearances
        UNION ALL SELECT 'edges', kind, count(*), 0 FROM pairs GROUP BY kind""",
        "games",
        "game_details",
        "teams",
        "appearances",
    ),
)
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vertices and edges in the two tables of the graph, written twice as by a repeated job, with their composite keys checked."""
    one = one_appearance(spark, sf_dir)
    played = appearances(views.game_details(spark, sf_dir, by_game=True), views.games(spark, sf_dir))
    parts = {
        "vertices": [graph.game_vertices(views.games(spark, sf_dir)), player_vertices(spark, sf_dir), graph.team_vertices(views.teams(spark, sf_dir))],
        "edges": [graph.plays_in(one), graph.plays_on(played), graph.pair_edges(graph.player_pairs(one))],
    }
    out = None
    for name, frames in parts.items():
        kind = schemas.TABLES[name].partitioned_by[0]
        table = schemas.create(spark, name, f"{name}_{uuid.uuid4().hex}")
        rows = files.stored(reduce(DataFrame.unionByName, [f.select(*spark.table(table).columns) for f in frames]), name)
        for _ in range(2):
            schemas.replace_partitions(rows, table)
        counts = spark.table(table).groupBy(F.col(kind).alias("type")).agg(F.count(F.lit(1)).alias("n_rows"))
        by_key = dealt(spark.table(table).select(*schemas.TABLES[name].key), schemas.TABLES[name].key, rows.count(), 1_000_000)
        repeated = schemas.key_problems(by_key, name).groupBy(F.col(kind).alias("type")).agg(F.count(F.lit(1)).alias("n_repeated_keys"))
        found = counts.join(repeated, "type", "left").select(
            F.lit(name).alias("of"), "type", "n_rows", F.coalesce("n_repeated_keys", F.lit(0)).cast("long").alias("n_repeated_keys")
        )
        out = found if out is None else out.unionByName(found)
    return out
