"""Cumulative dimension tables: one row per entity and snapshot with its history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio
from ledgerline.operators.grouping import dealt
from ledgerline.operators.spine import period_spine
from ledgerline.operators.steps import snapshot_before

Classify = Callable[[Column], Column]

#: Entities whose whole history, a row per period at most, one task holds.
ENTITIES_PER_TASK = 20_000


def cumulate_step(
    prev: DataFrame,
    today: DataFrame,
    key: str,
    static_cols: Sequence[str],
    hist_cols: Sequence[str],
    time: str,
    as_of: int,
    value: str,
    classify: Classify,
) -> DataFrame:
    """Yesterday's snapshot and today's rows make the snapshot ``as_of``.

    ``prev`` has key, statics, ``history`` (array of structs of ``hist_cols``,
    built by name), ``class``, ``years_since_last_active``, ``is_active`` and
    ``current``; of several snapshots only that of ``as_of`` - 1 is read, and
    its absence is an error. ``today`` has one row per key. History only grows for entities
    present today; their class is recomputed, others keep theirs.
    """
    history_type = prev.schema["history"].dataType.simpleString()
    p, t = snapshot_before(prev, "current", as_of - 1).alias("p"), today.alias("t")
    here = F.col(f"t.{time}").isNotNull()
    empty = F.array().cast(history_type)
    entry = F.array(F.struct(*[F.col(f"t.{c}").alias(c) for c in hist_cols])).cast(history_type)
    return p.join(t, F.col(f"p.{key}") == F.col(f"t.{key}"), "full_outer").select(
        F.coalesce(f"p.{key}", f"t.{key}").alias(key),
        *[F.coalesce(f"p.{c}", f"t.{c}").alias(c) for c in static_cols],
        F.concat(F.coalesce("p.history", empty), F.when(here, entry).otherwise(empty)).alias("history"),
        F.when(here, classify(F.col(f"t.{value}"))).otherwise(F.col("p.class")).alias("class"),
        F.when(here, F.lit(0)).otherwise(F.col("p.years_since_last_active") + 1).alias("years_since_last_active"),
        here.alias("is_active"),
        F.lit(as_of).alias("current"),
    )


def cumulate_backfill(
    rows: DataFrame,
    key: str,
    time: str,
    last: int,
    static_cols: Sequence[str],
    hist_cols: Sequence[str],
    value: str,
    classify: Classify,
    only_last: bool = False,
) -> DataFrame:
    """All snapshots up to ``last`` in one pass, same columns as ``cumulate_step``.

    ``rows`` is unique on (key, time). Statics are the maximum seen. With
    ``only_last`` the earlier snapshots are not built.
    """
    known = rows.filter(F.col(time) <= last)
    entry = [F.struct(*hist_cols).alias("entry"), F.col(value).alias("value")]
    statics = [F.max(c).alias(c) for c in static_cols]
    spine = period_spine(known, [key], time, F.lit(last), entry, statics, only_last)
    so_far = F.slice("_all", 1, F.col("_i") + 1)
    return spine.select(
        key,
        *static_cols,
        F.transform(so_far, lambda e: e["entry"]).alias("history"),
        classify(F.col("_now.value")).alias("class"),
        (F.col(time) - F.col("_now._p")).cast("int").alias("years_since_last_active"),
        F.col("is_active"),
        F.col(time).cast("int").alias("current"),
    )


def last_to_first_ratio(snapshot: DataFrame, key: str, field: str, name: str = "ratio") -> DataFrame:
    """Latest over first history value; a zero first value counts as 1."""
    first = F.try_element_at("history", F.lit(1))[field]
    last = F.try_element_at("history", F.lit(-1))[field]
    base = F.when(first == 0, F.lit(1.0)).otherwise(first.cast("double"))
    return snapshot.select(key, (last.cast("double") / base).alias(name))


def explode_history(snapshot: DataFrame, key: str) -> DataFrame:
    """One row per history entry."""
    return snapshot.select(key, F.inline("history"))


def yearly_quality(
    rows: DataFrame, key: str, year: str, rating: str, last: int, classify: Classify, entities: int | None = None
) -> DataFrame:
    """Per entity and year up to ``last``: class of the latest year with rows, activity flag.

    With their number in ``entities``, entities are dealt out over tasks of
    bounded size once their years are added up, and stay there.
    """
    per_year = (
        rows.filter(F.col(year) <= last)
        .groupBy(key, F.col(year).cast("int").alias("current_year"))
        .agg(F.sum(rating).alias("total"), F.count(rating).alias("n"))
    )
    if entities is not None:
        per_year = dealt(per_year, [key], entities, ENTITIES_PER_TASK)
    entry = [F.col("total"), F.col("n")]
    spine = period_spine(per_year, [key], "current_year", F.lit(last), entry)
    average = ratio(F.col("_now.total"), F.col("_now.n"))
    return spine.select(key, "current_year", classify(average).alias("quality_class"), "is_active")


def quality_class(rows: DataFrame, key: str, year: str, rating: str, classify: Classify) -> DataFrame:
    """Class by the average rating of each entity's most recent year."""
    per_year = rows.groupBy(key, year).agg(F.sum(rating).alias("_sum"), F.count(rating).alias("_n"))
    latest = per_year.groupBy(key).agg(F.max_by(F.struct("_sum", "_n"), year).alias("_l"), F.max(year).alias("last_year"))
    average = ratio(F.col("_l._sum"), F.col("_l._n"))
    return latest.select(key, "last_year", average.alias("avg_rating"), classify(average).alias("quality_class"))


def _totals_of(
    rows: DataFrame, key: str, year: str, rating: str, sums: dict[str, str], ends: dict[str, tuple[str, str]], count: str
) -> DataFrame:
    """Per entity: totals of all its items, rating sums of its latest year, and that year."""
    names = [c for pair in ends.values() for c in pair]
    per_year = rows.groupBy(key, year).agg(
        F.count(F.lit(1)).alias(count),
        *[F.sum(c).cast("long").alias(name) for c, name in sums.items()],
        *[end(c).alias(name) for c, pair in ends.items() for end, name in zip((F.min, F.max), pair)],
        F.sum(rating).alias("_sum"),
        F.count(rating).alias("_n"),
    )
    return per_year.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in (count, *sums.values())],
        *[(F.max if i % 2 else F.min)(c).alias(c) for i, c in enumerate(names)],
        F.max_by(F.struct("_sum", "_n"), year).alias("_latest"),
        F.max(year).alias("_last"),
    )


def films_totals(
    rows: DataFrame,
    key: str,
    year: str,
    rating: str,
    as_of: int,
    classify: Classify,
    sums: dict[str, str],
    ends: dict[str, tuple[str, str]],
    count: str = "n_items",
) -> DataFrame:
    """One row per entity as of a year: totals of all items so far, class of its latest year, activity flag.

    ``sums`` names the sum of a column, ``ends`` its least and largest value;
    nulls count in neither. The items stay rows: an entity's are added up in
    each task before the shuffle, however many it has.
    """
    found = _totals_of(rows.filter(F.col(year) <= as_of), key, year, rating, sums, ends, count)
    return found.select(
        key,
        *[c for c in found.columns if c not in (key, "_latest", "_last")],
        classify(ratio(F.col("_latest._sum"), F.col("_latest._n"))).alias("quality_class"),
        (F.col("_last") == as_of).alias("is_active"),
        F.lit(as_of).alias("current_year"),
    )


def films_totals_step(
    prev: DataFrame,
    rows: DataFrame,
    key: str,
    year: str,
    rating: str,
    as_of: int,
    classify: Classify,
    sums: dict[str, str],
    ends: dict[str, tuple[str, str]],
    count: str = "n_items",
) -> DataFrame:
    """Last year's totals and the items of ``as_of`` make this year's: the same rows as ``films_totals``.

    Of ``prev`` only the snapshot of ``as_of`` - 1 is read, and its absence is
    an error; of ``rows`` only one year.
    """
    now = _totals_of(rows.filter(F.col(year) == as_of), key, year, rating, sums, ends, count).alias("n")
    p = snapshot_before(prev, "current_year", as_of - 1).alias("p")
    here = F.col("n._last").isNotNull()

    def added(c: str) -> Column:
        return F.coalesce(F.col(f"p.{c}") + F.col(f"n.{c}"), f"p.{c}", f"n.{c}").alias(c)

    average = ratio(F.col("n._latest._sum"), F.col("n._latest._n"))
    return p.join(now, F.col(f"p.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"p.{key}", f"n.{key}").alias(key),
        *[added(c) for c in (count, *sums.values())],
        *[end(f"p.{c}", f"n.{c}").alias(c) for pair in ends.values() for end, c in zip((F.least, F.greatest), pair)],
        F.when(here, classify(average)).otherwise(F.col("p.quality_class")).alias("quality_class"),
        here.alias("is_active"),
        F.lit(as_of).alias("current_year"),
    )
