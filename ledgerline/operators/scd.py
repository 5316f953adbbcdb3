"""Type-2 history: value, first and last period of each unbroken stretch.

Input snapshots are unique on (key, period), so one key never has more rows
than there are periods and a window per key stays small whatever the number
of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import changed
from ledgerline.operators.steps import snapshot_before


def change_indicators(df: DataFrame, key: str, period: str, tracked: Sequence[str]) -> DataFrame:
    """Previous value and 0/1 change flag per tracked column; the first row counts as changed."""
    order = Window.partitionBy(key).orderBy(period)
    first = F.row_number().over(order) == 1
    out = df
    for column in tracked:
        before = F.lag(column).over(order)
        flag = F.when(first | changed(F.col(column), before), 1).otherwise(0)
        out = out.withColumn(f"previous_{column}", before).withColumn(f"{column}_changed", flag)
    return out


def scd2_backfill(
    df: DataFrame, key: str, period: str, tracked: Sequence[str], as_of: int | None = None
) -> DataFrame:
    """Whole history from snapshots up to ``as_of``; missing periods do not end a stretch."""
    known = df if as_of is None else df.filter(F.col(period) <= as_of)
    order = Window.partitionBy(key).orderBy(period)
    state = F.struct(*tracked)
    starts = F.when((F.row_number().over(order) == 1) | changed(state, F.lag(state).over(order)), 1).otherwise(0)
    streak = F.sum("_starts").over(order)
    out = (
        known.select(key, period, *tracked)
        .withColumn("_starts", starts)
        .withColumn("_streak", streak)
        .groupBy(key, "_streak", *tracked)
        .agg(F.min(period).alias("start_period"), F.max(period).alias("end_period"))
        .drop("_streak")
    )
    if as_of is None:
        return out
    return out.withColumn("current", F.lit(as_of))


def scd2_compare(open_rows: DataFrame, current: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Current rows next to the open history row of the same key, if any."""
    c, o = current.alias("c"), open_rows.alias("o")
    differs = F.lit(False)
    for column in tracked:
        differs = differs | changed(F.col(f"c.{column}"), F.col(f"o.{column}"))
    status = (
        F.when(F.col(f"o.{key}").isNull(), "new").when(differs, "changed").otherwise("unchanged")
    )
    return c.join(o, F.col(f"c.{key}") == F.col(f"o.{key}"), "left").select(
        F.col(f"c.{key}").alias(key),
        *[F.col(f"c.{x}").alias(x) for x in tracked],
        *[F.col(f"o.{x}").alias(f"open_{x}") for x in tracked],
        F.col("o.start_period").alias("open_start"),
        status.alias("status"),
    )


def scd2_incremental(
    prev: DataFrame,
    current: DataFrame,
    key: str,
    period: str,
    tracked: Sequence[str],
    as_of: int,
    drop_absent: bool = False,
) -> DataFrame:
    """History as of ``as_of`` from the previous history and one new snapshot.

    ``prev`` has key, tracked columns, ``start_period``, ``end_period`` and
    ``current``, perhaps of many snapshots; only that of ``as_of`` - 1 is read,
    and its absence is an error. Open rows end in the previous period. One full outer join of
    open rows and snapshot decides everything: unchanged rows are extended,
    changed ones are closed and reopened, new keys opened. An open row whose
    key is absent now is kept as closed unless ``drop_absent``.
    """
    fields = [*tracked, "start_period", "end_period"]
    before = as_of - 1
    known = snapshot_before(prev, "current", before)
    closed = known.filter(F.col("end_period") < before).select(key, *fields)
    o = known.filter(F.col("end_period") >= before).select(key, *fields).alias("o")
    c = current.filter(F.col(period) == as_of).select(key, period, *tracked).alias("c")

    old = F.struct(*[F.col(f"o.{f}").alias(f) for f in fields])
    opened = F.struct(
        *[F.col(f"c.{x}").alias(x) for x in tracked],
        F.col(f"c.{period}").alias("start_period"),
        F.col(f"c.{period}").alias("end_period"),
    )
    extended = F.struct(
        *[F.col(f"c.{x}").alias(x) for x in tracked],
        F.col("o.start_period").alias("start_period"),
        F.col(f"c.{period}").alias("end_period"),
    )
    same = F.lit(True)
    for column in tracked:
        same = same & F.col(f"o.{column}").eqNullSafe(F.col(f"c.{column}"))
    is_new = F.col(f"o.{key}").isNull()
    absent = F.col(f"c.{key}").isNull()
    kept = F.array(old) if not drop_absent else F.filter(F.array(old), lambda _: F.lit(False))
    records = (
        F.when(is_new, F.array(opened))
        .when(absent, kept)
        .when(same, F.array(extended))
        .otherwise(F.array(old, opened))
    )
    moved = (
        o.join(c, F.col(f"o.{key}") == F.col(f"c.{key}"), "full_outer")
        .select(F.coalesce(f"o.{key}", f"c.{key}").alias(key), F.explode(records).alias("_r"))
        .select(key, "_r.*")
    )
    return closed.unionByName(moved).withColumn("current", F.lit(as_of))
