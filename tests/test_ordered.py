from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ordered


@pytest.fixture(scope="module")
def data():
    """Three keys, one holding most rows; the chunk never decreases in t."""
    rng = random.Random(7)
    rows = [(0, t, rng.randint(0, 3)) for t in range(400)]
    rows += [(1, t, rng.randint(0, 3)) for t in range(60)]
    rows += [(2, t, 0) for t in range(5)]
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    shuffled = data[:]
    random.Random(1).shuffle(shuffled)
    base = spark.createDataFrame(shuffled, "k int, t int, v int").repartition(5)
    return base.withColumn("c", F.floor(F.col("t") / 7))


def by_key(data):
    out = {}
    for k, t, v in sorted(data):
        out.setdefault(k, []).append(v)
    return out


def test_running_sums(df, data):
    got = {(r["k"], r["t"]): (r["total"], r["n"]) for r in ordered.running_sums(
        df, ["k"], "c", ["t"], {"total": F.col("v"), "n": F.lit(1)}).collect()}
    want = {}
    for k, values in by_key(data).items():
        for i in range(len(values)):
            want[(k, i)] = (sum(values[: i + 1]), i + 1)
    assert got == want


def test_previous_row_crosses_chunks(df, data):
    got = {(r["k"], r["t"]): r["before"] and r["before"]["v"] for r in ordered.previous_row(
        df, ["k"], "c", ["t"], ["v"], "before").collect()}
    want = {(k, i): (values[i - 1] if i else None) for k, values in by_key(data).items() for i in range(len(values))}
    assert got == want


@pytest.mark.parametrize("length", [1, 3, 50])
def test_stretch_best(df, data, length):
    got = {r["k"]: r["best"] for r in ordered.stretch_best(df, ["k"], "c", ["t"], F.col("v"), length, "best").collect()}
    want = {
        k: max(sum(v[i : i + length]) for i in range(len(v) - length + 1))
        for k, v in by_key(data).items()
        if len(v) >= length
    }
    assert got == want


def test_stretch_best_over_block_edges(spark):
    """More rows than one block of the numbering, best stretch across the edge."""
    df = spark.range(10_000).select(
        F.lit(1).alias("k"), F.col("id").alias("t"), F.floor(F.col("id") / 500).alias("c"),
        F.col("id").between(4090, 4105).cast("int").alias("v"),
    )
    got = ordered.stretch_best(df, ["k"], "c", ["t"], F.col("v"), 20, "best").first()["best"]
    assert got == 16


def test_longest_run(df, data):
    got = {r["k"]: r["run"] for r in ordered.longest_run(df, ["k"], "c", ["t"], F.col("v") > 0, "run").collect()}

    def longest(values):
        best = now = 0
        for v in values:
            now = now + 1 if v > 0 else 0
            best = max(best, now)
        return best

    assert got == {k: longest(v) for k, v in by_key(data).items()}


def test_chunks_follow_rows_not_ids(spark):
    """A thousand sparse numbers on few days are one chunk; a large day is cut; a null key or day is kept."""
    sparse = [("a", i % 9, i * 1_000_003) for i in range(1000)]
    large = [("b", d, i * 17) for d, n in ((1, 30), (2, 5000), (3, 30)) for i in range(n)]
    data = [*sparse, *large, (None, 1, 5), ("c", None, 6), ("c", 1, None)]
    df = spark.createDataFrame(data, "k string, day int, id long")
    got = ordered.chunked(df, ["k"], "day", "id", rows=1000)
    assert got.count() == len(data) and got.columns == ["k", "day", "id", "_chunk"]
    sizes = {r["k"]: [] for r in got.collect()}
    for r in got.groupBy("k", "_chunk").count().collect():
        sizes[r["k"]].append(r["count"])
    assert sizes["a"] == [1000] and len(sizes["b"]) in (6, 7) and max(sizes["b"]) < 1100
    ordered_rows = sorted((r["day"], r["id"], tuple(r["_chunk"])) for r in got.filter("k = 'b'").collect())
    assert [r[2] for r in ordered_rows] == sorted(r[2] for r in ordered_rows)


def test_running_sums_over_chunks(spark):
    data = [("a", i // 40, i * 101, i) for i in range(400)]
    df = ordered.chunked(spark.createDataFrame(data, "k string, day int, id long, v int"), ["k"], "day", "id", rows=16)
    got = ordered.running_sums(df, ["k"], "_chunk", ["day", "id"], {"total": F.col("v")})
    assert {r["v"]: r["total"] for r in got.collect()} == {i: i * (i + 1) // 2 for i in range(400)}
