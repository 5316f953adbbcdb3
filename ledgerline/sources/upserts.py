"""Replacing rows by key in a table of partitions, touching no other partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.quality import duplicate_keys
from ledgerline.session import scratch_path
from ledgerline.sources.files import path_exists, upsert, write_partitioned


def touched_partitions(new: DataFrame, by: Sequence[str]) -> list[tuple]:
    """The partitions that ``new`` has rows for; their number is one of folders, not of rows."""
    return [tuple(r) for r in new.select(*by).distinct().collect()]


def in_partitions(by: Sequence[str], values: Sequence[tuple]) -> Column:
    """A condition on partition columns alone; null is a value like any other."""

    def same(row: tuple) -> Column:
        return reduce(Column.__and__, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(by, row)])

    return reduce(Column.__or__, map(same, values), F.lit(False))


def merged_partitions(old: DataFrame, new: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The new content of the touched partitions: their old rows with other keys, and all of ``new``.

    Other partitions of ``old`` are not read. The partition columns ``by`` must
    belong to the key, so that a key cannot also be in a partition that is not
    looked at. A key that ``new`` has twice is an error.
    """
    if not set(by) <= set(keys):
        raise ValueError(f"partition columns {list(by)} must be among the keys {list(keys)}")
    twice = duplicate_keys(new, keys).first()
    if twice is not None:
        raise ValueError(f"two new rows for one key: {twice.asDict()}")
    there = old.filter(in_partitions(by, touched_partitions(new, by)))
    return upsert(there, new.select(*old.columns), keys)


def upsert_table(spark: SparkSession, path: str, schema: str, new: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Upsert ``new`` into the parquet folders at ``path`` and return the table.

    The merged partitions are written to a fresh folder first and then switched in,
    each as a whole, by a partition overwrite; readers of other partitions see no
    change. Merging again gives the same rows, so a run that fails anywhere is
    repeated from the start. Without anything at ``path`` the table begins with
    ``new``.
    """
    empty = spark.createDataFrame([], schema)
    old = spark.read.schema(empty.schema).parquet(path).select(empty.columns) if path_exists(spark, path) else empty
    merged = merged_partitions(old, new, keys, by)
    fresh = write_partitioned(merged, scratch_path(spark, "merged"), by)
    write_partitioned(spark.read.schema(old.schema).parquet(fresh), path, by)
    return spark.read.schema(old.schema).parquet(path).select(old.columns)
