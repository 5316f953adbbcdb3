from __future__ import annotations

import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from ledgerline.catalog import q_activity, q_dims, q_graph, views
from ledgerline.operators import activity, arrays, graph, growth, patterns, quality, scd, stretches
from ledgerline.sources import schemas
from ledgerline.streaming.events import topic_options

DAY = date(2024, 1, 10)


def made(spark, small):
    """One frame per stored table, straight from its operator."""
    events = views.web_events(spark, small)
    states = q_dims.states(spark, small)
    lists = activity.active_dates_backfill(events, ["user_id"], "event_time", DAY)
    pairs = graph.player_pairs(patterns.one_per_game(views.game_details(spark, small)))
    tracked = ["class", "is_active"]
    actors = q_dims.actor_states(spark, small)
    films = stretches.history_backfill(
        views.actor_films(spark, small), "actorid", "year", q_dims.FILM, "rating", 1998, q_dims.quality, 8
    )
    return {
        "players": q_dims.history_until(spark, small, 2000),
        "players_scd": scd.scd2_backfill(states, "player_name", "current", tracked, 2000),
        "actors_history_scd": scd.scd2_backfill(actors, "actorid", "current_year", q_dims.TRACKED, 2000),
        "actors_films": films[0],
        "actors": films[1],
        "vertices": graph.game_vertices(views.games(spark, small)).unionByName(q_graph.player_vertices(spark, small)),
        "edges": graph.pair_edges(pairs),
        "users_cumulated": lists,
        "user_datelist_int": activity.datelist(lists, DAY),
        "user_devices_cumulated": q_activity.browser_map(spark, small),
        "hosts_cumulated": activity.active_dates_backfill(events, ["host"], "event_time", DAY),
        "host_activity_reduced": arrays.host_month(events, "host", "user_id", "event_time", DAY),
        "array_metrics": arrays.array_metric_backfill(events, "user_id", "event_time", "hits", DAY),
        "monthly_user_site_hits": arrays.monthly_hits_backfill(events, "user_id", "event_time", DAY),
        "users_growth_accounting": growth.growth_backfill(events, "user_id", "event_time", DAY),
    }


def test_operators_fill_their_tables(spark, small):
    for name, df in made(spark, small).items():
        assert schemas.shape_problems(df, name) == [], name
        assert schemas.key_problems(df, name).count() == 0, name


def test_daily_runs_replace_one_partition(spark, small):
    events = views.web_events(spark, small)
    target = "cumulated_" + schemas.scratch_path(spark, "t").rsplit("-", 1)[1]
    schemas.create(spark, "users_cumulated", target)
    schemas.create(spark, "users_cumulated", target)  # a second call changes nothing
    for day in (DAY, DAY + timedelta(days=1)):
        for _ in range(2):  # each day runs twice
            before = spark.table(target).filter(F.col("date") == F.lit(day - timedelta(days=1)))
            if before.isEmpty():
                before = activity.active_dates_backfill(events, ["user_id"], "event_time", day - timedelta(days=1))
            step = activity.active_dates_step(before, events, ["user_id"], "event_time", day)
            schemas.replace_partitions(step, target)
    stored = spark.table(target).filter(F.col("date") == F.lit(DAY + timedelta(days=1)))
    want = activity.active_dates_backfill(events, ["user_id"], "event_time", DAY + timedelta(days=1))
    assert rows(stored, *want.columns) == rows(want)
    assert spark.table(target).select("date").distinct().count() == 2
    schemas.drop(spark, target)
    assert not spark.catalog.tableExists(target)


def test_first_step_starts_from_the_empty_table(spark, small):
    events = views.web_events(spark, small)
    first = growth.growth_step(schemas.empty(spark, "users_growth_accounting"), events, "user_id", "event_time", date(2024, 1, 1))
    assert {r["daily_active_state"] for r in first.collect()} == {"New"}


def test_problems_are_named(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "user_id int, other int")
    assert schemas.shape_problems(df, "user_datelist_int") == [
        "missing datelist_int", "missing date", "unknown other", "user_id is int, not bigint",
    ]
    bad = spark.createDataFrame([("a", DAY), ("a", DAY), (None, DAY)], "host string, date date")
    assert rows(schemas.key_problems(bad, "hosts_cumulated"), "host", "n_rows") == [("a", 2), (None, 1)]


def test_typed_read_refuses_nulls(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("ref", T.StringType(), True)])
    df = spark.createDataFrame([("1", None, "x")], "id string, ref string, extra string")
    assert rows(quality.typed(df, schema)) == [(1, None)]
    with pytest.raises(Exception, match="null in required column id"):
        quality.typed(spark.createDataFrame([(None, "a")], "id string, ref string"), schema).collect()


def test_topic_options():
    got = topic_options("host:9092", "events", **{"kafka.security.protocol": "SASL_SSL"})
    assert got["startingOffsets"] == "latest" and got["kafka.security.protocol"] == "SASL_SSL"


def test_replacing_partitions_sorts_only_beyond_the_open_files(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    setting, seen, insert = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.insertInto
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda self, *a, **b: seen.append(spark.conf.get(setting)) or insert(self, *a, **b))
    before = spark.conf.get(setting)
    table = schemas.create(spark, "vertices", f"vertices_{uuid.uuid4().hex}")
    kinds = [f"k{i}" for i in range(schemas.OPEN_FILES + 3)]
    data = [(i, kind, {"n": str(i)}) for kind in kinds for i in range(20)]
    for shift in (0, 1):
        df = spark.createDataFrame([(i + shift, k, p) for i, k, p in data], spark.table(table).select("identifier", "type", "properties").schema)
        schemas.replace_partitions(df.repartition(2), table)
        assert sorted((r.identifier, r.type) for r in spark.table(table).collect()) == sorted((i + shift, k) for i, k, _ in data)
    assert seen == [str(schemas.OPEN_FILES)] * 2 and spark.conf.get(setting) == before
