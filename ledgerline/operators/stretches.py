"""Histories of any length: an entity's items in numbered stretches of bounded width.

A full stretch is written once, in the period that completed it, and never
again. The last, open stretch travels in the entity's snapshot row; a step
rewrites that alone. So neither a row nor a step grows with an entity's history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio
from ledgerline.operators.grouping import group_parts, spread, with_parts
from ledgerline.operators.steps import snapshot_before

Classify = Callable[[Column], Column]


def number_items(
    rows: DataFrame, key: str, period: str, order: Sequence[str], name: str = "ordinal", max_rows: int = 100_000
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... per key by ``period`` and ``order``.

    A period of a key with more than ``max_rows`` items is dealt out by a hash of
    ``order`` and numbered part by part, so no task orders all of a large key;
    inside such a period the hash comes before ``order``.
    """
    parted = spread(rows, [key, period], order, max_rows, "_part")
    counted = parted.groupBy(key, period, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(key).orderBy(period, "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        F.col(key).alias("_key"), F.col(period).alias("_period"), F.col("_part").alias("_slot"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy(key, period, "_part").orderBy(*order))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(period).eqNullSafe(F.col("_period")) & (F.col("_part") == F.col("_slot"))
    return parted.withColumn("_place", place).join(starts, same).select(
        *rows.columns, (F.col("_start") + F.col("_place") - 1).alias(name)
    )


def _numbered_apart(
    rows: DataFrame, key: str, period: str, order: Sequence[str], max_rows: int
) -> list[DataFrame]:
    """``number_items`` in two frames of different keys.

    A key of at most ``max_rows`` items is numbered and listed where one shuffle
    by the key puts it; only larger keys go through the parts. The list of those
    has at most rows / ``max_rows`` keys.
    """
    told = with_parts(rows, F.broadcast(group_parts(rows, [key], max_rows)), [key])
    place = F.row_number().over(Window.partitionBy(key).orderBy(period, *order))
    small = told.filter(F.col("_parts") == 1).select(*rows.columns, (place - 1).cast("long").alias("ordinal"))
    large = told.filter(F.col("_parts") > 1).select(*rows.columns)
    return [small, number_items(large, key, period, order, max_rows=max_rows)]


def _stretches(numbered: DataFrame, key: str, period: str, item_cols: Sequence[str], width: int) -> DataFrame:
    """``key, stretch, items, last``: the items of each stretch in order and their latest period."""
    entry = F.struct("ordinal", F.struct(period, *item_cols).alias("item"))
    grouped = numbered.groupBy(key, F.floor(F.col("ordinal") / width).alias("stretch"))
    listed = grouped.agg(F.sort_array(F.collect_list(entry)).alias("_all"), F.max(period).alias("last"))
    return listed.select(key, "stretch", F.transform("_all", lambda e: e["item"]).alias("items"), "last")


def _latest(rows: DataFrame, key: str, period: str, rating: str) -> DataFrame:
    """Per entity: number of items, rating sums of its latest period, and that period."""
    per_period = rows.groupBy(key, period).agg(
        F.count(F.lit(1)).alias("_items"), F.sum(rating).alias("_sum"), F.count(rating).alias("_n")
    )
    return per_period.groupBy(key).agg(
        F.sum("_items").alias("_total"), F.max_by(F.struct("_sum", "_n"), period).alias("_rated"), F.max(period).alias("_last")
    )


def _known(rows: DataFrame, key: str, period: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull() & F.col(period).isNotNull())


def history_backfill(
    rows: DataFrame,
    key: str,
    period: str,
    item_cols: Sequence[str],
    rating: str,
    as_of: int,
    classify: Classify,
    width: int = 1000,
    max_rows: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Closed stretches and the snapshot as of a period, in one pass.

    Closed: ``key, stretch, items, closed_in``, ``width`` structs (period,
    ``item_cols``) a row. Snapshot: ``key, n_items, items, quality_class,
    is_active, current``, where ``items`` are the fewer than ``width`` of the open
    stretch. The class is that of the average rating in the latest period. Rows
    without key or period belong to no history; repeated rows are items each.
    """
    known = _known(rows, key, period).filter(F.col(period) <= as_of)
    small, large = [_stretches(n, key, period, item_cols, width) for n in _numbered_apart(known, key, period, item_cols, max_rows)]
    listed = small.unionByName(large)
    full = F.size("items") == width
    closed = listed.filter(full).select(key, "stretch", "items", F.col("last").cast("int").alias("closed_in"))
    tail = listed.filter(~full).select(F.col(key).alias("_key"), F.col("items").alias("_open"))
    found = _latest(known, key, period, rating).join(tail, F.col(key) == F.col("_key"), "left")
    kind = listed.schema["items"].dataType.simpleString()
    snapshot = found.select(
        key,
        F.col("_total").alias("n_items"),
        F.coalesce("_open", F.array().cast(kind)).alias("items"),
        classify(ratio(F.col("_rated._sum"), F.col("_rated._n"))).alias("quality_class"),
        (F.col("_last") == as_of).alias("is_active"),
        F.lit(as_of).alias("current"),
    )
    return closed, snapshot


def history_step(
    prev: DataFrame,
    rows: DataFrame,
    key: str,
    period: str,
    item_cols: Sequence[str],
    rating: str,
    as_of: int,
    classify: Classify,
    width: int = 1000,
    max_rows: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """The stretches closed in ``as_of`` and its snapshot, from the snapshot before and one period of rows.

    Folding steps over all periods gives what ``history_backfill`` gives in one
    pass. No closed stretch is read; of ``prev`` only the snapshot of ``as_of`` - 1
    is, and its absence is an error. Write both results as partitions of
    ``as_of``: a repeated step replaces them by the same rows.
    """
    before = snapshot_before(prev, "current", as_of - 1)
    kind = prev.schema["items"].dataType.simpleString()
    empty = F.array().cast(kind)
    now = _known(rows, key, period).filter(F.col(period) == as_of)
    counts = before.select(F.col(key).alias("_key"), F.col("n_items").alias("_had"))
    placed = number_items(now, key, period, item_cols, max_rows=max_rows).join(counts, F.col(key) == F.col("_key"), "left")
    numbered = placed.withColumn("ordinal", F.col("ordinal") + F.coalesce("_had", F.lit(0)))
    listed = _stretches(numbered, key, period, item_cols, width)
    open_before = before.select(
        F.col(key).alias("_key"), F.floor(F.col("n_items") / width).alias("_stretch"), F.col("items").alias("_open")
    )
    same = (F.col(key) == F.col("_key")) & (F.col("stretch") == F.col("_stretch"))
    grown = listed.join(open_before, same, "left").select(
        key, "stretch", F.concat(F.coalesce("_open", empty), F.col("items").cast(kind)).alias("items")
    )
    full = F.size("items") == width
    closed = grown.filter(full).select(key, "stretch", "items", F.lit(as_of).alias("closed_in"))
    tail = grown.filter(~full).select(F.col(key).alias("_key"), F.col("items").alias("_open"))
    p, n = before.alias("p"), _latest(now, key, period, rating).alias("n")
    here = F.col("n._last").isNotNull()
    merged = p.join(n, F.col(f"p.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"p.{key}", f"n.{key}").alias(key),
        (F.coalesce("p.n_items", F.lit(0)) + F.coalesce("n._total", F.lit(0))).alias("n_items"),
        F.when(~here, F.col("p.items")).alias("_kept"),
        F.when(here, classify(ratio(F.col("n._rated._sum"), F.col("n._rated._n")))).otherwise(F.col("p.quality_class")).alias("quality_class"),
        here.alias("is_active"),
        F.lit(as_of).alias("current"),
    )
    snapshot = merged.join(tail, F.col(key) == F.col("_key"), "left").select(
        key, "n_items", F.coalesce("_kept", "_open", empty).alias("items"), "quality_class", "is_active", "current"
    )
    return closed, snapshot


def whole_history(closed: DataFrame, snapshots: DataFrame, key: str, as_of: int, width: int = 1000) -> DataFrame:
    """``key, stretch, items`` with the state of the entity: all its items as of a period, a row per stretch.

    ``closed`` and ``snapshots`` may be stored tables of many periods; later
    partitions are not read.
    """
    state = snapshots.filter(F.col("current") == as_of)
    last = state.filter(F.size("items") > 0).select(key, F.floor(F.col("n_items") / width).alias("stretch"), "items")
    rows = closed.filter(F.col("closed_in") <= as_of).select(key, "stretch", "items").unionByName(last)
    return rows.join(state.select(key, "quality_class", "is_active", "current"), key)
