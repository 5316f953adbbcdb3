"""Shared parts of the training-data operators: inputs, staged tables, Arrow helpers, dense numbers, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: ASCII white space between words, as a Java character class.
WORD_GAP = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared scratch folder and read it back: later jobs survive a lost executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Smaller slices of the incoming batches, so that few texts are Python objects at once."""
    for batch in batches:
        step = rows
        if batch.num_rows and batch.get_total_buffer_size() > size:
            step = max(1, min(rows, size * batch.num_rows // batch.get_total_buffer_size()))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from one sequence per field."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable keeps the optimizer from copying ``value`` into every
    place that ``body`` reads it.
    """
    return F.transform(F.array(value), body)[0]


def uniform(*parts: Column | str) -> Column:
    """A reproducible number in [0, 1) for each value of ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def numbered(
    df: DataFrame, order: Sequence[Column], bucket: Column, name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... per ``within`` without one task seeing all rows of it.

    Rows go by ``bucket`` first and by ``order`` inside it. Bucket sizes are
    counted, their running sum is one small table, and each bucket is ordered
    on its own; so a bucket, not a whole group, must fit a task's sort.
    ``order`` must be total for a result that does not depend on arrival.
    """
    keyed = df.withColumn("_bucket", bucket)
    counted = keyed.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(*within, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy(*order))
    return (
        keyed.withColumn("_place", place)
        .join(starts, [*within, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_start")
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of undirected ``edges`` (a, b).

    Alternates large and small stars: each round links a node's neighbours to
    the smallest of them, and stops when a round changes nothing. The smallest
    neighbour is an aggregate that is combined before the shuffle; the join
    back has one row per node on its other side, so a hub's edges can be split.
    Every round is written to the shared folder; only counts reach the driver.
    """
    now = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), label
    )
    mark = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        spread = large.join(low, "u")
        small = spread.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = staged(small.filter("u <> v").distinct(), label)
        was, mark = mark, _fingerprint(now)
        if was == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]
