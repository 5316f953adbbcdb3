"""Keeping large groups apart: de-duplication, splitting and checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, nulls first.

    Without ``order`` all other columns decide, so the pick never depends on
    arrival. A given ``order`` must settle every column read later; the
    columns outside it can then be pruned from the scan. Each task keeps its
    own first row per key before the shuffle, however many copies a key has.
    """
    ranked = [c for c in df.columns if c not in keys] if order is None else list(order)
    if not ranked:
        return df.dropDuplicates(list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def dealt(df: DataFrame, keys: Sequence[str], rows: int, rows_per_task: int = 200_000) -> DataFrame:
    """Rows hashed by ``keys`` over as many tasks as ``rows`` needs, at least those of the session's shuffles.

    Adaptive execution joins small partitions by their packed bytes, and packed
    rows of a few columns unfold to many times that in sorts and hash tables.
    Partitions made here stay as they are, so what a task sorts or groups on
    these keys does not grow with the table. ``rows`` is that of the largest
    table put together on the keys; all of them take the same figure.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // rows_per_task)), *[F.col(k) for k in keys])


def large_groups(
    counted: DataFrame, keys: Sequence[str], max_rows: int, carry: Sequence[str] = ()
) -> DataFrame:
    """Keys whose count ``_n`` is above ``max_rows`` and into how many parts to split them."""
    big = counted.filter(F.col("_n") > max_rows)
    return big.select(*keys, F.ceil(F.col("_n") / max_rows).cast("int").alias("_parts"), *carry)


def group_parts(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """``large_groups`` of a table: at most rows/max_rows keys, ordinary keys do not appear."""
    return large_groups(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, max_rows)


def with_parts(
    df: DataFrame, parts: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Add ``_parts``, 1 for ordinary keys, and ``carry`` columns, null for them.

    A null key is a key like any other.

    ``parts`` comes from ``group_parts`` and joins without a hint: adaptive
    execution broadcasts it when its measured size allows and shuffles
    otherwise.
    """
    renamed = parts.withColumnsRenamed({k: f"_big_{k}" for k in keys}).withColumnRenamed("_parts", "_found")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_big_{key}"))
    joined = df.join(renamed, same, "left")
    return joined.select(*df.columns, F.coalesce("_found", F.lit(1)).alias("_parts"), *carry)


def spread(df: DataFrame, keys: Sequence[str], by: Sequence[str], max_rows: int, part: str = "part") -> DataFrame:
    """Add ``part``: 0 for ordinary groups, a hash of ``by`` for groups above ``max_rows``."""
    return assign_part(with_parts(df, group_parts(df, keys, max_rows), keys), by, part)


def assign_part(df: DataFrame, by: Sequence[str], part: str = "part") -> DataFrame:
    """Replace ``_parts`` by the part each row hashes to."""
    return df.withColumn(part, F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int")).drop("_parts")


def replicate(df: DataFrame, part: str = "part") -> DataFrame:
    """Replace ``_parts`` by one copy of the row for each part of its key."""
    return df.withColumn(part, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")


def lists_by_range(df: DataFrame, keys: Sequence[str], item: str, name: str, width: int = 1000) -> DataFrame:
    """Sorted lists of whole numbers, one row per key and stretch of ``width`` numbers.

    ``part`` is the item divided by ``width``, rounded down. The form does not
    depend on how many items a key has, and a list of distinct items never has
    more than ``width``.
    """
    part = F.floor(F.col(item) / width).alias("part")
    return df.select(*keys, item, part).groupBy(*keys, "part").agg(F.sort_array(F.collect_set(item)).alias(name))
