from __future__ import annotations

import os
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerline.catalog import q_batch, views
from ledgerline.operators import experiments, matches, web
from ledgerline.operators.grouping import lists_by_range
from ledgerline.plans import inspect
from ledgerline.plans.jobs import cached, run_job, run_table_job
from ledgerline.session import scratch_path, scratch_root
from ledgerline.sources import files, geo, layout

EVENT = "user_id int, device_id int, host string, referrer string, url string, event_time timestamp"
NOW = datetime(2024, 1, 1, 10)


@pytest.fixture(scope="module")
def events(spark):
    data = [(u % 5 if u % 7 else None, u % 4, f"h{u % 2}", None if u % 3 else "r", "/x", NOW) for u in range(40)]
    return spark.createDataFrame(data, EVENT)


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame(
        [(0, "a", "o", "t"), (1, "b", "o", "t"), (2, "c", None, "t")], "device_id int, browser_type string, os_type string, device_type string"
    )


def test_rollups_have_one_row_per_key_whatever_its_size(spark, devices):
    rows_ = [(u, 0 if u < 400 else 1, f"h{u % 7}") for u in range(500) for _ in range(1 + u % 2)]
    events = spark.createDataFrame(rows_, "user_id long, device_id long, host string")
    hosts = web.user_device_hosts(events)
    pairs = web.user_device_hits(hosts)
    assert pairs.groupBy("user_id", "device_id").count().filter("count > 1").count() == 0
    assert pairs.agg(F.sum("event_counts")).first()[0] == len(rows_)
    hits = web.user_device_counts(events)
    per_device = {r["device_id"]: (r["n_users"], r["user_sum"]) for r in web.device_rollup(hits, devices).collect()}
    assert per_device[0] == (400, sum(range(400)))
    assert rows(web.user_rollup(hits), "user_id", "total_hits", "n_devices", "device_sum")[1] == (1, 2, 1, 0)
    listed = lists_by_range(hits, ["device_id"], "user_id", "users", 4)
    assert listed.agg(F.sum(F.size("users"))).first()[0] == hits.count()


def test_enrichments(spark, events, devices):
    typed = web.enrich_typed(events, devices)
    assert typed.filter("referrer is null or user_id is null").count() == 0
    assert {r[0] for r in typed.select("browser_type").distinct().collect()} == {"A", "B", "C"}
    assert typed.count() == web.enrich_plain(events, devices).count()
    left = web.enrich_left(events, devices)
    assert left.count() == events.count() and left.filter("browser_family is null").count() > 0
    assert left.first()["event_date"] == date(2024, 1, 1)


def test_dataframe_and_sql_forms_agree(spark, events, devices):
    events.createOrReplaceTempView("typed_events")
    devices.createOrReplaceTempView("typed_devices")
    sql = spark.sql(
        "SELECT e.*, browser_type, os_type, device_type FROM typed_events e JOIN typed_devices d "
        "ON e.device_id = d.device_id WHERE user_id IS NOT NULL AND e.device_id IS NOT NULL"
    )
    plain = web.enrich_plain(events, devices)
    assert rows(sql, *plain.columns) == rows(plain)


def test_cached_aggregate_is_used_by_both_rollups(spark, events, devices):
    hits = web.user_device_counts(events).persist()
    try:
        assert "InMemoryTableScan" in inspect.plan_text(web.user_rollup(hits))
        assert "InMemoryTableScan" in inspect.plan_text(web.device_rollup(hits, devices))
    finally:
        hits.unpersist()


def test_csv_schema_inference_and_text(spark):
    path = files.write_csv(spark.createDataFrame([(1, "a"), (2, None)], "id int, v string"), scratch_path(spark, "csv"))
    assert rows(files.read_csv(spark, path, "id int, v string")) == [(1, "a"), (2, None)]
    assert dict(files.read_csv(spark, path, infer=True).dtypes)["id"] == "int"
    assert dict(files.read_csv(spark, path).dtypes)["id"] == "string"


def test_partition_overwrite_leaves_other_days(spark):
    path = scratch_path(spark, "days")
    files.write_partitioned(spark.createDataFrame([("d1", 1), ("d2", 2)], "ds string, v int"), path, ["ds"])
    files.write_partitioned(spark.createDataFrame([("d2", 9)], "ds string, v int"), path, ["ds"])
    assert rows(spark.read.parquet(path), "ds", "v") == [("d1", 1), ("d2", 9)]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert rows(files.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]


def test_jobs(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    spark.createDataFrame([("d1", 1), ("d2", 2)], "ds string, v int").write.parquet(src)
    run_job(spark, src, lambda df: df.withColumn("v", F.col("v") * 10), dst, ["ds"])
    run_job(spark, src, lambda df: df.filter("ds = 'd2'"), dst, ["ds"])
    assert rows(spark.read.parquet(dst), "ds", "v") == [("d1", 10), ("d2", 2)]
    with pytest.raises(ValueError):
        run_job(spark, src, lambda df: df, src)


def test_table_jobs_insert_by_name(spark):
    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    source, target = f"src_{tag}", f"dst_{tag}"
    spark.createDataFrame([(1, "a")], "k int, v string").write.option("path", scratch_path(spark, "s")).saveAsTable(source)
    spark.createDataFrame([], "v string, k int").write.option("path", scratch_path(spark, "d")).saveAsTable(target)
    run_table_job(spark, source, lambda df: df, target)
    assert rows(spark.table(target), "k", "v") == [(1, "a")]


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# -- layout -----------------------------------------------------------------


def test_sort_within_partitions_needs_no_range_shuffle(spark, events):
    local = layout.sorted_within(events, ["host"], ["host", "url"], 4)
    assert "rangepartitioning" not in inspect.plan_text(local)
    assert "rangepartitioning" in inspect.plan_text(layout.sorted_global(events, ["host", "url"]))


def test_rows_are_in_order_where_they_lie(spark, events):
    placed = layout.sorted_within(events, ["host"], ["host", "url"]).withColumns(
        {"place": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
    )
    found = sorted((r["place"], r["at"], r["host"], r["url"]) for r in placed.collect())
    for (p1, _, *one), (p2, _, *two) in zip(found, found[1:]):
        assert p1 != p2 or one <= two
    assert placed.groupBy("host").agg(F.count_distinct("place").alias("n")).filter("n > 1").count() == 0


def test_sorted_and_unsorted_copies_by_year(spark, small):
    df = views.matches(spark, small)
    paths = {n: scratch_path(spark, n) for n in ("plain", "sorted")}
    layout.write_by_year(df, paths["plain"], "completion_date")
    layout.write_by_year(df, paths["sorted"], "completion_date", ["completion_date", "playlist_id"])
    stats = {r["table_name"]: r["n_rows"] for r in layout.file_stats(spark, paths).collect()}
    assert stats == {"plain": df.count(), "sorted": df.count()}
    one = spark.read.parquet(paths["sorted"]).filter("year = 1997")
    assert "PartitionFilters: [isnotnull(year" in inspect.plan_text(one)
    assert one.filter("year(completion_date) <> 1997").count() == 0


def test_a_folder_gets_few_files(spark):
    df = spark.range(200).repartition(8).withColumn("ds", F.col("id") % 2)
    path = files.write_partitioned(df, scratch_path(spark, "few"), ["ds"])
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 2


def test_buckets_grow_with_the_table(spark):
    assert layout.buckets_for(1000) == 16
    assert layout.buckets_for(1000, rows_per_bucket=20) == 64
    assert layout.buckets_for(600_000_000_000) == layout.MOST_BUCKETS < 100_000


def test_stored_parts_count_and_large_keys(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("k"))
    parts, n = layout.stored_parts(df, "k", 25)
    assert (rows(parts), n) == ([(0, 3)], 100)


def test_hot_value_is_dealt_over_partitions(spark):
    df = spark.range(1000).select(F.lit("d").alias("ds"), F.col("id"))
    placed = layout.spread_by(df, ["ds"], 8, max_rows=100).withColumn("p", F.spark_partition_id())
    assert placed.select("p").distinct().count() > 3 and placed.count() == 1000


def test_sorted_copy_is_smaller(spark, small):
    df = views.match_details(spark, small).join(views.matches(spark, small), "match_id")
    orders = {"low": ["playlist_id", "mapid", "match_id"], "high": ["player_gamertag"]}
    tie = ["match_id", "player_gamertag", "player_total_deaths"]
    out = layout.layout_study(df, orders, tie, {"on_map": ("mapid", 7)}, 8)
    got = {r["table_name"]: r for r in out.collect()}
    assert got["low"]["n_rows"] == got["high"]["n_rows"] == df.count()
    assert got["low"]["n_files"] == got["high"]["n_files"] == 8
    assert got["low"]["n_bytes"] < got["high"]["n_bytes"] and (got["low"]["rank_by_bytes"], got["high"]["rank_by_bytes"]) == (1, 2)
    again = {r["table_name"]: r for r in layout.layout_study(df.repartition(5), orders, tie, {"on_map": ("mapid", 7)}, 8).collect()}
    assert {n: (r["rank_by_bytes"], r["on_map"]) for n, r in got.items()} == {n: (r["rank_by_bytes"], r["on_map"]) for n, r in again.items()}


def test_files_are_equal_cuts_of_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    path = layout.in_equal_files(df.repartition(6), ["v"], scratch_path(spark, "equal"), 8)
    got = spark.read.parquet(path).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    assert rows(got) == [(i, 125, 125 * i, 125 * i + 124) for i in range(8)]
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 8
    touched = layout.files_touched(spark, path, {"one": ("v", 300), "none": ("v", 5000)})
    assert rows(touched, "n_files", "n_rows", "one", "none") == [(8, 1000, 1, 0)]


def test_no_rows_no_files(spark):
    path = layout.in_equal_files(spark.range(0), ["id"], scratch_path(spark, "none"), 4)
    assert [f for f in os.listdir(path) if f.startswith("file=")] == []


def test_interleaved_order_serves_every_column(spark):
    df = spark.range(64 * 64).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    mixed = layout.interleaved(df, ["a", "b"], 6)
    want = {(x, y): sum((x >> i & 1) << 2 * i + 1 | (y >> i & 1) << 2 * i for i in range(6)) for x in range(64) for y in range(64)}
    assert {(r.a, r.b): r.interleaved for r in mixed.collect()} == want
    touched = {}
    for name, order in (("mixed", ["interleaved"]), ("by a", ["a", "b"])):
        path = layout.in_equal_files(mixed, [*order, "a", "b"], scratch_path(spark, "z"), 64)
        touched[name] = rows(layout.files_touched(spark, path, {"one": ("a", 9), "other": ("b", 9)}), "one", "other")[0]
    assert touched == {"mixed": (8, 8), "by a": (1, 64)}


def test_interleaved_keys_of_texts_days_and_nulls(spark):
    data = [("1-URGENT", date(2024, 1, 1)), ("2-HIGH", date(2024, 1, 31)), (None, None), ("", date(2024, 1, 16)), ("3", None)]
    got = layout.interleaved(spark.createDataFrame(data, "t string, d date"), ["t", "d"], 5)
    keys = {(r.t, r.d): r.interleaved for r in got.collect()}
    assert keys[(None, None)] == 0 and len(set(keys.values())) == 5
    assert max(keys, key=lambda k: keys[k])[0] == "2-HIGH"  # nearly highest in one, highest in the other
    assert layout.interleaved(spark.createDataFrame([], "t string"), ["t"]).count() == 0


def test_types_of_texts(spark):
    data = [
        ("1", "1", "true", "2024-01-01", "2024-01-01 10:00:00", "x", None, "2024-02-30", "9223372036854775808"),
        ("-20", "2.5e3", "FALSE", "2023-12-31", "2024-01-01", "1", " ", "2024-01-01", "1"),
        (None, ".5", None, " ", "2024-01-01T10:00:00Z", None, None, None, None),
    ]
    names = ["whole", "number", "flag", "day", "moment", "mixed", "blank", "no such day", "too large"]
    texts = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
    types = files.infer_types(texts)
    assert types == dict(zip(names, ["bigint", "double", "boolean", "date", "timestamp", "string", "string", "string", "double"]))
    got = files.cast_types(texts, types)
    assert [t for _, t in got.dtypes] == list(types.values())
    assert rows(got.select("whole", "number", "day")) == sorted([(1, 1.0, date(2024, 1, 1)), (-20, 2500.0, date(2023, 12, 31)), (None, 0.5, None)], key=repr)
    assert set(files.infer_types(texts.limit(0)).values()) == {"string"}


def test_types_take_one_pass(spark, monkeypatch):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("types", "types")
    files.infer_types(spark.range(1000).select(F.col("id").cast("string").alias("t")).repartition(1))
    assert len(jobs.getJobIdsForGroup("types")) <= 3  # stages of one adaptive query
    spark.sparkContext.setJobGroup("", "")


def test_bad_lines_are_kept_whole(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('id,n,note\n1,2.5,a\nx,1,b\n3,,"c, d"\n4,1.0\n5,1,e,f\n')
    good, bad = files.read_csv_aside(spark, str(path), "id int, n double, note string")
    assert rows(good) == [(1, 2.5, "a"), (3, None, "c, d")]
    assert rows(bad) == [("4,1.0",), ("5,1,e,f",), ("x,1,b",)]


def test_a_cached_aggregate_is_read_twice_and_released(spark, events):
    hits = web.user_device_counts(events)
    with cached(hits) as kept:
        both = q_batch.rollups(kept)
        assert inspect.count_nodes(both, "InMemoryTableScan") == 2
        stored = files.stored(both, "both")
        assert kept.storageLevel.useMemory
    assert not hits.storageLevel.useMemory
    assert inspect.count_nodes(stored, "InMemoryTableScan") == 0
    assert rows(stored) == rows(q_batch.rollups(web.user_device_counts(events)))


def test_a_cached_frame_is_released_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError), cached(df):
        raise RuntimeError
    assert not df.storageLevel.useMemory


@pytest.fixture
def no_broadcast(spark):
    """Only hinted broadcasts, and joins may use part of their keys to stay in place."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_bucket_join_has_no_shuffle(spark, small, no_broadcast):
    large, rest = layout.colocate(
        views.match_details(spark, small),
        {
            "matches": (views.matches(spark, small), None),
            "medals": (views.medals_players(spark, small), ["player_gamertag"]),
        },
        "match_id",
        ["player_gamertag"],
    )
    joined = large.join(rest["matches"], ["match_id", "part"])
    assert inspect.shuffles(joined) == 0
    three = joined.join(rest["medals"].drop("count"), ["match_id", "part", "player_gamertag"])
    assert inspect.shuffles(three) == 0
    plain = views.match_details(spark, small).join(views.matches(spark, small), "match_id")
    assert inspect.shuffles(plain) == 2
    assert joined.count() == plain.count()


def test_hot_match_is_split_over_buckets(spark):
    details = spark.range(300).select(
        F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("match_id"), F.col("id").alias("player"), F.lit(1).alias("kills")
    )
    games = details.select("match_id").distinct().withColumn("map", F.col("match_id") % 3)
    large, rest = layout.colocate(details, {"games": (games, None)}, "match_id", ["player"], 4, max_rows=20)
    joined = large.join(rest["games"], ["match_id", "part"])
    assert large.filter("match_id = 0").select("part").distinct().count() == 5
    assert rows(joined, "match_id", "player", "map") == rows(details.join(games, "match_id"), "match_id", "player", "map")


def test_folders_of_both_sides_are_pruned(spark, small, no_broadcast):
    """The month of the matches prunes the details: at once if it is given, else while the query runs."""
    given = inspect.plan_text(q_batch.s17(spark, small))
    found = inspect.plan_text(q_batch.s17_dynamic(spark, small))
    assert len(re.findall(r"PartitionFilters: \[[^\]]*month#\d+ = 1996-01-01", given)) == 2
    assert len(re.findall(r"PartitionFilters: \[[^\]]*dynamicpruningexpression\(month#\d+ IN", found)) == 1
    for plan in (given, found):
        assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning\(match_id", plan)


def test_the_callers_settings_stay(spark, small):
    name = "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly"
    before = spark.conf.get(name)
    other = layout.pruning_session(spark)
    assert other.conf.get(name) == "false" and spark.conf.get(name) == before
    assert other.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_filters_and_columns_reach_the_scan(spark, small):
    df = views.table(spark, small, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert any("o_orderstatus" in f for f in inspect.pushed_filters(df))
    assert inspect.read_schemas(df) == ["o_orderkey:bigint,o_orderstatus:string"]


def test_match_leaders(spark):
    details = spark.createDataFrame([("a", 1, 4), ("a", 1, 2), ("b", 1, 5), ("b", 2, 2)], "player_gamertag string, match_id int, player_total_kills int")
    kills = matches.kills_per_game(details)
    assert rows(kills, "player_gamertag", "kills_per_game") == [("a", 6.0), ("b", 3.5)]
    assert matches.top(kills, "kills_per_game", "player_gamertag").first()["player_gamertag"] == "a"


# -- geo and experiments ----------------------------------------------------


def test_geo_hit_miss_bad_and_range_over_prefixes(spark):
    ranges = spark.createDataFrame(
        [(167772160, 167772160 + 3 * 65536 - 1, "C", "S", "T")], "ip_from long, ip_to long, country string, state string, city string"
    )
    df = spark.createDataFrame([("10.0.0.0",), ("10.2.255.255",), ("10.3.0.0",), ("bad",), (None,)], "ip string")
    out = geo.locate(df, ranges)
    assert not inspect.has_cross_join(out)
    got = dict(rows(out))
    place = '{"country":"C","state":"S","city":"T"}'
    assert got == {"10.0.0.0": place, "10.2.255.255": place, "10.3.0.0": "{}", "bad": "{}", None: "{}"}


def test_cells_are_stable_and_shares_are_kept(spark):
    users = spark.range(20000).withColumnRenamed("id", "u")
    cells = [("red", 50), ("blue", 30)]
    one = experiments.assign_cells(users, "u", "salt", cells, "none")
    two = experiments.assign_cells(users.repartition(7), "u", "salt", cells, "none")
    assert rows(one) == rows(two)
    share = {r["cell"]: r["count"] / 20000 for r in one.groupBy("cell").count().collect()}
    assert abs(share["red"] - 0.5) < 0.02 and abs(share["blue"] - 0.3) < 0.02 and abs(share["none"] - 0.2) < 0.02
    with pytest.raises(ValueError):
        experiments.assign_cells(users, "u", "s", [("a", 70), ("b", 40)], "none")


def test_only_outcomes_after_exposure_count(spark):
    exposures = spark.createDataFrame([(1, 5), (1, 3), (2, 4)], "u int, t int")
    outcomes = spark.createDataFrame([(1, 3, 10), (1, 4, 20), (1, 4, 5), (2, 1, 7)], "u int, t int, v int")
    assert rows(experiments.unit_outcomes(exposures, outcomes, "u", "t", "v")) == [(1, 3, 2, 25), (2, 4, 0, 0)]


def test_readouts_match_formulas(spark):
    control, treatment = [1.0, 2.0, 3.0, 4.0], [3.0, 5.0, 7.0]
    df = spark.createDataFrame([("c", x) for x in control] + [("t", x) for x in treatment], "cell string, x double")
    row = experiments.readout(df, "cell", "c", "t", "x", "lagging").first()
    var_c, var_t = 5 / 3, 4.0
    assert row["difference"] == 2.5
    assert row["t_value"] == pytest.approx(2.5 / (var_c / 4 + var_t / 3) ** 0.5)
    z = experiments.proportion_test(df, "cell", "c", "t", F.col("x") > 2, "big").first()
    p = 5 / 7
    assert z["z_value"] == pytest.approx(0.5 / (p * (1 - p) * (1 / 4 + 1 / 3)) ** 0.5)
    chi = rows(experiments.sample_ratio(df, "cell", [("c", 50), ("t", 50)]), "cell", "observed", "expected", "chi_square")
    assert chi == [("c", 4, 3.5, pytest.approx(1 / 14)), ("t", 3, 3.5, pytest.approx(1 / 14))]


def test_sample_ratio_sees_a_cell_without_units(spark):
    df = spark.createDataFrame([("a",)] * 10 + [("x",)], "cell string")
    got = rows(experiments.sample_ratio(df, "cell", [("a", 50), ("b", 50)]))
    assert [r[:5] for r in got] == [("a", 10, 5.0, 5.0, 10.0), ("b", 0, 5.0, 5.0, 10.0)]
    assert [r[5] for r in got] == pytest.approx([0.0015654, 0.0015654], abs=1e-7)
    none = experiments.sample_ratio(df.filter("cell = 'y'"), "cell", [("a", 50), ("b", 50)])
    assert rows(none, "cell", "observed", "chi_square") == [("a", 0, None), ("b", 0, None)]


def test_parity(spark):
    cells = spark.createDataFrame([("red",), ("blue",)], "cell string")
    with_parity = experiments.cell_parity(cells, "cell", ["red"])
    items = spark.range(5).withColumnRenamed("id", "i")
    assert rows(experiments.visible_items(with_parity, items, "i", "cell")) == [("blue", 1, 2), ("red", 0, 3)]


def test_stored_tables_follow_their_files(spark, tmp_path):
    path, built = str(tmp_path / "source"), []
    spark.range(5).write.parquet(path)
    for _ in range(2):
        layout.stored_once(spark, ("test",), [path], lambda: built.append(1))
    assert len(built) == 1
    spark.range(3).write.mode("append").parquet(path)
    layout.stored_once(spark, ("test",), [path], lambda: built.append(1))
    assert len(built) == 2
