from __future__ import annotations

import json
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from helpers import as_set, rows
from ledgerline.operators import facts, graph, quality

TEAM = "team_id long, abbreviation string, nickname string, city string, arena string, yearfounded long"


def test_one_vertex_per_team_with_text_properties(spark):
    herons = [(42, "LKH", name, "Lakeside", "Pier Hall", 1987) for name in ("Otters", "Herons", "Swans", "Herons")]
    df = spark.createDataFrame([*herons, (7, None, "Moles", "Underhill", None, 2003)], TEAM)
    found = {r["identifier"]: r for r in graph.team_vertices(df).collect()}
    assert set(found) == {7, 42} and {r["type"] for r in found.values()} == {"team"}
    assert found[42]["properties"]["nickname"] == "Herons" and found[42]["properties"]["year_founded"] == "1987"
    assert found[7]["properties"]["arena"] is None and set(found[7]["properties"]) == set(found[42]["properties"])


def test_json_keeps_null_properties(spark):
    df = spark.range(1).select(graph.properties(a=F.lit(None), b=F.lit(2)).alias("p"))
    assert json.loads(df.select(graph.properties_json(F.col("p"))).first()[0]) == {"a": None, "b": "2"}


def roster(spark):
    data = [(p, 1, p % 2, p) for p in range(12)] + [(p, 2, 0, 10) for p in (3, 5)] + [(3, 3, 1, 7)]
    return data, spark.createDataFrame(data, "player_id long, game_id long, team_id long, pts int")


@pytest.mark.parametrize("max_roster", [1000, 4])
def test_pairs_equal_brute_force_with_and_without_split(spark, max_roster):
    data, df = roster(spark)
    want = {}
    games = {}
    for p, g, t, pts in data:
        games.setdefault(g, []).append((p, t, pts))
    for members in games.values():
        for a, b in combinations(sorted(members, reverse=True), 2):
            kind = "shares_team" if a[1] == b[1] else "plays_against"
            n, x, y = want.get((a[0], b[0], kind), (0, 0, 0))
            want[(a[0], b[0], kind)] = (n + 1, x + a[2], y + b[2])
    assert rows(graph.player_pairs(df, max_roster)) == as_set(k + v for k, v in want.items())


def test_max_property_and_career(spark):
    _, df = roster(spark)
    details = df.withColumn("player_name", F.concat(F.lit("P"), F.col("player_id").cast("string")))
    vertices = graph.player_vertices(details)
    appearances = details.withColumns({"start_position": F.lit("C"), "team_abbreviation": F.lit("T")})
    best = dict(rows(graph.max_edge_property(vertices, graph.plays_in(appearances), "player_name", "pts", "m"), "identifier", "m"))
    assert best[3] == 10.0 and best[11] == 11.0
    pairs = graph.pair_edges(graph.player_pairs(df))
    career = graph.pair_with_career(vertices, pairs).filter("subject_identifier = 5 and object_identifier = 3")
    assert rows(career, "career_average", "total_points", "num_games") == [(7.5, 15, 2)]


def test_decimal_text_is_a_number_and_bad_text_is_skipped(spark):
    vertex = spark.createDataFrame([(1, "player", {"n": "x"}), (2, "player", {"n": "y"})], "identifier long, type string, properties map<string,string>")
    edge = spark.createDataFrame(
        [(1, "player", {"pts": "12.0"}), (1, "player", {"pts": "9"}), (2, "player", {"pts": "n/a"})],
        "subject_identifier long, subject_type string, properties map<string,string>",
    )
    assert rows(graph.max_edge_property(vertex, edge, "n", "pts", "m")) == as_set([(1, "x", 12.0), (2, "y", None)])


def test_career_of_nobody_is_null(spark):
    vertex = spark.createDataFrame(
        [(1, "player", {"player_name": "x", "total_points": "0", "number_of_games": "0"})],
        "identifier long, type string, properties map<string,string>",
    )
    edge = spark.createDataFrame(
        [(1, "player", 0, "player", "shares_team", {"num_games": "1", "subject_points": "2"})],
        "subject_identifier long, subject_type string, object_identifier long, object_type string, edge_type string, "
        "properties map<string,string>",
    )
    assert graph.pair_with_career(vertex, edge).first()["career_average"] is None


def test_model_keys_and_types(spark):
    _, df = roster(spark)
    edges = graph.pair_edges(graph.player_pairs(df))
    quality.assert_unique(edges, graph.EDGE_KEY)
    assert quality.outside_values(edges, "edge_type", graph.EDGE_TYPES).count() == 0
    assert quality.outside_values(edges, "subject_type", graph.VERTEX_TYPES).count() == 0


DETAIL = ["game_id", "team_id", "player_id", "player_name", "start_position", "comment", "min", *facts.MEASURES]


def details(spark, *data):
    schema = "game_id int, team_id int, player_id int, player_name string, start_position string, comment string, min string, "
    schema += ", ".join(f"{m} double" for m in facts.MEASURES)
    return spark.createDataFrame([(*d, *[float(i) for i in range(len(facts.MEASURES))]) for d in data], schema)


def test_fact_build(spark):
    from datetime import date

    games = spark.createDataFrame([(1, date(2020, 1, 2), 2019, 7)], "game_id int, game_date date, season int, home_team_id int")
    df = details(
        spark,
        (1, 7, 3, "P", "C", None, "10:30"),
        (1, 7, 3, "P", "C", None, "10:30"),
        (1, 8, 4, "Q", None, "DNP - Coach, NWT", "5"),
    )
    got = rows(
        facts.build_facts(df, games),
        "dim_player_id", "dim_is_playing_at_home", "dim_did_not_play", "dim_did_not_dress", "dim_not_with_team", "m_minutes", "m_pts",
    )
    assert got == [(3, True, False, False, False, 10.5, 14), (4, False, True, False, True, 5.0, 14)]


def test_flag_rate(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "k string, f boolean")
    got = [tuple(r) for r in facts.flag_rate(df, "k", F.col("f"), "n", "h", "r").collect()]
    assert got == [("a", 2, 1, 0.5), ("b", 1, 0, 0.0)]


def test_sample_keeps_whole_keys(spark):
    df = spark.range(2000).select((F.col("id") % 200).alias("u"))
    kept = facts.sample_by_key(df, "u", 20).groupBy("u").count()
    sizes = {r["count"] for r in kept.collect()}
    assert sizes == {10} and 15 < kept.count() < 70


# -- checks -----------------------------------------------------------------


def test_unique_and_null_contract(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "k int, v string")
    assert rows(quality.key_report(df, ["k"])) == [(3, 2, 1, 1)]
    with pytest.raises(ValueError):
        quality.assert_unique(df, ["k"])
    got = rows(quality.null_counts(df, ["k"], ["v"]))
    assert got == as_set([("k", 1, False), ("v", 1, True)])


def test_required_column_stops_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert quality.enforce_not_null(df.filter("k = 1"), ["k"]).count() == 1
    with pytest.raises(Exception, match="null in required column k"):
        quality.enforce_not_null(df, ["k"]).collect()
