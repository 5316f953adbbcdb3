from __future__ import annotations

import zlib
from collections import Counter
from math import comb, exp, lgamma

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import sharding


@pytest.mark.parametrize(("good", "total", "drawn"), [(3, 10, 4), (40, 100, 20), (0, 5, 2), (5, 5, 3), (7, 9, 0), (0, 0, 0)])
def test_hypergeometric_law(spark, good, total, drawn):
    n = 20_000
    draws = spark.range(n).select(
        sharding.hypergeometric(sharding.uniform("id"), F.lit(good), F.lit(total), F.lit(drawn)).alias("x")
    )
    got = {r["x"]: r["count"] for r in draws.groupBy("x").count().collect()}
    assert all(max(0, drawn - total + good) <= x <= min(good, drawn) for x in got)
    for x in range(min(good, drawn) + 1):
        want = n * comb(good, x) * comb(total - good, drawn - x) / comb(total, drawn) if drawn - x <= total - good else 0
        assert abs(got.get(x, 0) - want) < 6 * (want**0.5 + 1)


def test_large_hypergeometric(spark):
    big = [sharding.uniform("id"), F.lit(750_000_000), F.lit(30_000_000_000), F.lit(15_000_000_000)]
    row = spark.range(4).select(sharding.hypergeometric(*big).alias("x")).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    assert 375_000_000 - 100_000 < row["lo"] < row["hi"] < 375_000_000 + 100_000


@pytest.mark.parametrize(("good", "total", "drawn"), [(60_000, 100_000, 50_000), (20_000, 1_000_000, 500_000), (400, 1000, 500)])
def test_ratio_of_uniforms_follows_the_law(spark, monkeypatch, good, total, drawn):
    """Counts of each value against exact probabilities, in bins of a quarter of a standard deviation."""
    monkeypatch.setattr(sharding, "WIDE", 1.0)
    n = 40_000
    draws = spark.range(n).select(
        sharding.hypergeometric(sharding.uniform("id"), F.lit(good), F.lit(total), F.lit(drawn)).alias("x")
    )
    spread = (drawn * (good / total) * (1 - good / total) * (total - drawn) / (total - 1)) ** 0.5
    width = max(1, round(spread / 4))
    mean = drawn * good // total
    got = Counter((r["x"] - mean) // width for r in draws.collect())
    log_all = lgamma(total + 1) - lgamma(drawn + 1) - lgamma(total - drawn + 1)

    def chance(x):
        parts = ((good, x), (total - good, drawn - x))
        return exp(sum(lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1) for a, b in parts) - log_all)

    for bin_ in range(-14, 15):
        want = n * sum(chance(x) for x in range(mean + bin_ * width, mean + (bin_ + 1) * width) if 0 <= x <= min(good, drawn))
        assert abs(got.get(bin_, 0) - want) < 5 * (want**0.5 + 1)


def test_huge_counts_take_few_steps(spark):
    """A root draw over 10^11 rows; walking its values would take a million steps a draw."""
    total, good, drawn = 10**11, 10**11 // 40, 10**11 // 32
    draws = spark.range(4000).select(
        sharding.hypergeometric(sharding.uniform("id"), F.lit(good), F.lit(total), F.lit(drawn)).alias("x")
    )
    row = draws.agg(F.avg("x").alias("mean"), F.stddev("x").alias("sd"), F.count_distinct("x").alias("n")).first()
    spread = (drawn / 40 * (39 / 40) * (31 / 32)) ** 0.5
    assert abs(row["mean"] - drawn / 40) < 5 * spread / 4000**0.5 and abs(row["sd"] / spread - 1) < 0.06 and row["n"] > 3600


def test_equal_rows_fill_even_blocks(spark):
    rows = spark.range(9000, numPartitions=5).select(F.when(F.col("id") < 6000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_rows(rows, shards=6, rows_per_block=100)
    counts = Counter((r.shard, r.doc_id == 7) for r in got.collect())
    assert all(counts[s, True] + counts[s, False] == 1500 for s in range(6))
    assert all(abs(counts[s, True] - 1000) < 110 for s in range(6))
    key = ("doc_id", "size")
    numbered = sharding._copies_numbered(rows.select("doc_id", F.lit(20).alias("size"), F.monotonically_increasing_id().alias("_at")), key)
    copies = sorted(r["copy"] for r in numbered.filter("doc_id = 7").collect())
    assert copies == list(range(6000)) and numbered.filter("doc_id <> 7 and copy > 0").count() == 0


@pytest.mark.parametrize("blocks", [1, 7, 50])
def test_matrix_sums(spark, blocks):
    sizes = [(b, 10 + 3 * b) for b in range(blocks) if b != 3]
    n = sum(s for _, s in sizes)
    capacities = [n // 6 + (j < n % 6) for j in range(6)]
    rows = sharding.communication_matrix(spark.createDataFrame(sizes, "block long, n long"), blocks, capacities, "s").collect()
    assert {r.block: sum(r.sent) for r in rows} == dict(sizes)
    assert [sum(r.sent[j] for r in rows) for j in range(6)] == capacities


def test_shards(docs, plain):
    rows = sharding.shard_rows(docs, rows_per_block=16).collect()
    texts = {r[0]: (r[1] or "").encode() for r in plain}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in texts.items()}
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(40):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
    again = sharding.shard_rows(docs.repartition(3), rows_per_block=16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_uniform(spark):
    """A row's shard does not depend on its block, nor its slot on its shard."""
    rows = spark.range(8000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = sharding.shard_rows(rows, shards=8, rows_per_block=200).collect()
    for part in ((r.doc_id % 2, r.shard) for r in got), ((r.doc_id // 4000, r.shard) for r in got), ((r.shard, r.slot // 500) for r in got):
        counts = Counter(part)
        assert all(abs(c - 500) < 130 for c in counts.values()) and len(counts) == 16


def test_odd_rows(odd):
    rows = sharding.shard_rows(odd, shards=3).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [3, 3, 4]
    null = next(r for r in rows if r.doc_id == 1)
    assert (null["size"], null.text_crc32) == (16, 0)


def test_empty_table(none):
    assert sharding.shard_rows(none).collect() == []


def test_native(docs):
    from ledgerline.plans import inspect

    assert not inspect.uses_python(sharding.shard_rows(docs))
