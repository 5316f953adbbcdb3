from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from helpers import rows
from ledgerline.operators import grouping as g
from ledgerline.plans import inspect


def skewed(spark, n=900):
    """A third of the rows share key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_dedupe_keeps_smallest_whatever_the_arrival(spark):
    data = [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 5), (2, "x", 1)]
    want = [(1, "a", 3), (2, None, 5)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, s string, n int").repartition(3)
        assert rows(g.dedupe(df, ["k"])) == sorted(want, key=repr)
        assert rows(g.dedupe(df, ["k"], ["s", "n"])) == sorted(want, key=repr)


def test_dedupe_by_all_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(g.dedupe(df, ["k"])) == [(1,), (2,)]


def test_dedupe_thins_out_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    plan = inspect.plan_text(g.dedupe(df, ["k"]))
    # Once on each side of the exchange.
    assert plan.count("WindowGroupLimit") == 2


def test_spread_splits_only_large_groups(spark):
    out = g.spread(skewed(spark), ["k"], ["v"], 100)
    parts = rows(out.groupBy("k").agg(F.count_distinct("part").alias("p"), F.count(F.lit(1)).alias("n")))
    assert (0, 3, 300) in parts
    assert all(p == 1 for k, p, _ in parts if k != 0)
    assert out.count() == 900


def test_a_large_null_group_is_split_too(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = g.spread(df, ["k"], ["v"], 25)
    assert out.count() == 300
    assert out.filter("k is null").select("part").distinct().count() == 4


def test_replicate_meets_every_part(spark):
    df = skewed(spark)
    dim = df.select("k").distinct().withColumn("label", F.col("k") * 2)
    big = g.group_parts(df, ["k"], 100)
    joined = g.spread(df, ["k"], ["v"], 100).join(g.replicate(g.with_parts(dim, big, ["k"])), ["k", "part"])
    assert joined.count() == 900
    assert joined.filter("label <> k * 2").count() == 0


def test_lists_by_range_keep_every_item_in_bounded_lists(spark):
    out = g.lists_by_range(skewed(spark), ["k"], "v", "items", 100).collect()
    assert max(len(r["items"]) for r in out) <= 100
    assert Counter(v for r in out for v in r["items"]) == Counter(range(900))
    assert all(r["items"] == sorted(r["items"]) and {v // 100 for v in r["items"]} == {r["part"]} for r in out)


def test_dealt_takes_as_many_tasks_as_rows_need(spark):
    df = skewed(spark, 1000)
    for rows_per_task, tasks in ((100, 10), (10_000, 4)):
        dealt = g.dealt(df, ["k"], 1000, rows_per_task)
        assert f", {tasks}), REPARTITION_BY_NUM" in inspect.plan_text(dealt)
        assert rows(dealt) == rows(df)
        places = dealt.withColumn("p", F.spark_partition_id()).select("k", "p").distinct()
        assert places.count() == df.select("k").distinct().count()
