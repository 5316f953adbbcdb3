from __future__ import annotations

import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common


def edges_of(kind: str) -> list[tuple[int, int]]:
    if kind == "chain":
        return [(i, i + 1) for i in range(200)]
    if kind == "star":
        return [(500, i) for i in range(300)]
    if kind == "none":
        return []
    rng = random.Random(kind)
    return [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]


@pytest.mark.parametrize("kind", ["chain", "star", "none", "r1", "r2"])
def test_components(spark, kind):
    edges = edges_of(kind)
    got = common.components(spark.createDataFrame(edges * 2, "a long, b long")).collect()
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    linked = {frozenset(e) for e in edges}
    want = brute.grouped(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("buckets", [1, 5, 1000])
def test_numbers_have_no_gaps(spark, buckets):
    rows = spark.range(300).select("id", (F.col("id") % 3).alias("g"))
    got = common.numbered(rows, [F.col("id")], F.floor(F.col("id") * buckets / 300), "n", ["g"]).collect()
    assert {r["id"]: r["n"] for r in got} == {i: i // 3 for i in range(300)}


def test_pieces_are_bounded_by_rows_and_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100] * 1000)], names=["t"])
    assert [b.num_rows for b in common.pieces(iter([batch]), 300)] == [300, 300, 300, 100]
    assert max(b.num_rows for b in common.pieces(iter([batch]), 300, 10_000)) <= 100
    assert sum(b.num_rows for b in common.pieces(iter([batch]), 300, 1)) == 1000
    assert list(common.pieces(iter([batch.slice(0, 0)]))) == []


def test_let_keeps_one_value_per_row(spark):
    got = spark.range(5).select(common.let(F.rand(), lambda v: v - v).alias("d")).collect()
    assert {r["d"] for r in got} == {0.0}
