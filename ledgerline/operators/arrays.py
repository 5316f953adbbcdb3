"""Month arrays: one slot per day of the month for each entity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.steps import snapshot_before

MONTH_SLOTS = 31


def daily_counts(events: DataFrame, keys: Sequence[str], time: str, value: Column | None = None) -> DataFrame:
    """(keys, day, n); rows with a null key part are left out before the shuffle."""
    kept = events
    for key in keys:
        kept = kept.filter(F.col(key).isNotNull())
    measure = F.count(F.lit(1)) if value is None else value
    return kept.groupBy(*keys, F.to_date(time).alias("day")).agg(measure.alias("n"))


def _slots_before(day: date) -> int:
    return day.day - 1


def _whole(array: str, day: date) -> Column:
    """``array``, which must have a slot for each earlier day of the month and no other, or null."""
    pad = _slots_before(day)
    message = F.concat(F.lit(f"{day} needs {pad} slots, found "), F.size(array).cast("string"))
    refused = F.raise_error(message).cast("array<bigint>")
    return F.when(F.col(array).isNull() | (F.size(array) == pad), F.col(array)).otherwise(refused)


def array_metric_step(
    prev: DataFrame, events: DataFrame, user: str, time: str, metric: str, day: date
) -> DataFrame:
    """Add one day to the month arrays of ``metric``.

    ``prev`` has user, month_start, metric_name, metric_array. A new user gets
    zeros for the earlier days, an absent one a zero for today. An array that
    already holds the day's slot is an error, so a day cannot be added twice.
    """
    month = day.replace(day=1)
    pad = _slots_before(day)
    today = daily_counts(events.filter(F.to_date(time) == F.lit(day)), [user], time).alias("t")
    p = prev.filter((F.col("month_start") == F.lit(month)) & (F.col("metric_name") == metric)).alias("p")
    old = F.coalesce(_whole("p.metric_array", day), F.array_repeat(F.lit(0).cast("long"), pad))
    return p.join(today, F.col(f"p.{user}") == F.col(f"t.{user}"), "full_outer").select(
        F.coalesce(f"p.{user}", f"t.{user}").alias(user),
        F.lit(month).alias("month_start"),
        F.lit(metric).alias("metric_name"),
        F.concat(old, F.array(F.coalesce("t.n", F.lit(0).cast("long")))).alias("metric_array"),
    )


def month_arrays(
    daily: DataFrame, keys: Sequence[str], values: dict[str, str], as_of: date, fill_zero: bool = True
) -> DataFrame:
    """All days of the month up to ``as_of`` at once from (keys, day, ...) rows.

    ``values`` maps each output array to its input column. ``daily`` is unique
    on (keys, day): at most 31 entries meet per key.
    """
    month = as_of.replace(day=1)
    known = daily.filter(F.col("day").between(F.lit(month), F.lit(as_of)))
    entry = F.struct(*[F.col(c).cast("long").alias(n) for n, c in values.items()])
    per_key = known.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), entry))).alias("_m"),
        F.min("day").alias("first_found_date"),
    )
    numbers = F.sequence(F.lit(1), F.lit(as_of.day))

    def array(name: str) -> Column:
        def slot(number: Column) -> Column:
            found = F.try_element_at("_m", number)[name]
            return F.coalesce(found, F.lit(0).cast("long")) if fill_zero else found

        return F.transform(numbers, slot).alias(name)

    return per_key.select(
        *keys, F.lit(month).alias("month_start"), *[array(n) for n in values], "first_found_date"
    )


def array_metric_backfill(events: DataFrame, user: str, time: str, metric: str, as_of: date) -> DataFrame:
    """Month arrays as of one day in a single pass; equal to repeating the step."""
    arrays = month_arrays(daily_counts(events, [user], time), [user], {"metric_array": "n"}, as_of)
    return arrays.select(user, "month_start", F.lit(metric).alias("metric_name"), "metric_array")


def array_lengths(df: DataFrame, array: str) -> DataFrame:
    return df.groupBy(F.size(array).alias("n_slots")).agg(F.count(F.lit(1)).alias("n_rows"))


def arrays_to_daily(df: DataFrame, by: Sequence[str], array: str, name: str) -> DataFrame:
    """Element-wise totals per group, one row per day.

    Slots are summed in place, so no row is multiplied before the shuffle.
    """
    sums = [F.sum(F.get(array, F.lit(i))).alias(f"_s{i}") for i in range(MONTH_SLOTS)]
    totals = df.groupBy(*by, "month_start").agg(F.max(F.size(array)).alias("_len"), *sums)
    slots = F.slice(F.array(*[F.col(f"_s{i}") for i in range(MONTH_SLOTS)]), F.lit(1), F.col("_len"))
    return totals.select(*by, "month_start", F.posexplode(slots).alias("_pos", name)).select(
        *by, F.date_add("month_start", F.col("_pos")).alias("day"), name
    )


def monthly_hits_step(prev: DataFrame, events: DataFrame, user: str, time: str, day: date) -> DataFrame:
    """Null-filled hit arrays with the first day seen, as the next daily partition.

    Of ``prev`` only this month's partition of the day before is read; the
    first of a month starts anew. A month without that partition, or an array
    of another length, is an error.
    """
    month = day.replace(day=1)
    pad = _slots_before(day)
    today = daily_counts(events.filter(F.to_date(time) == F.lit(day)), [user], time).alias("t")
    p = snapshot_before(prev.filter(F.col("month_start") == F.lit(month)), "date_partition", day - timedelta(days=1)).alias("p")
    blank = F.array_repeat(F.lit(None).cast("bigint"), pad)
    old = _whole("p.hit_array", day)
    return p.join(today, F.col(f"p.{user}") == F.col(f"t.{user}"), "full_outer").select(
        F.coalesce(f"p.{user}", f"t.{user}").alias(user),
        F.concat(F.coalesce(old, blank), F.array("t.n")).alias("hit_array"),
        F.lit(month).alias("month_start"),
        F.least("p.first_found_date", "t.day").alias("first_found_date"),
        F.lit(day).alias("date_partition"),
    )


def monthly_hits_backfill(events: DataFrame, user: str, time: str, as_of: date) -> DataFrame:
    arrays = month_arrays(
        daily_counts(events, [user], time), [user], {"hit_array": "n"}, as_of, fill_zero=False
    )
    return arrays.select(
        user, "hit_array", "month_start", "first_found_date", F.lit(as_of).alias("date_partition")
    )


def first_days(
    df: DataFrame, array: str, partition: str, value: object, names: Sequence[str], keep_null: bool = False
) -> DataFrame:
    """Per month, the totals of the first slots within one partition.

    An absent slot counts as 0, or with ``keep_null`` as nothing: a day that no
    row has a value for is then null.
    """
    zero = F.lit(0).cast("long")
    slots = [F.get(array, F.lit(i)) for i in range(len(names))]
    sums = [F.sum(s if keep_null else F.coalesce(s, zero)).alias(n) for s, n in zip(slots, names)]
    return df.filter(F.col(partition) == F.lit(value)).groupBy("month_start").agg(*sums)


def host_month(events: DataFrame, host: str, user: str, time: str, as_of: date) -> DataFrame:
    """Per host and month: hits and distinct visitors per day as two arrays."""
    daily = events.groupBy(host, F.to_date(time).alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct(user).alias("visitors")
    )
    both = {"hit_array": "hits", "unique_visitors": "visitors"}
    return month_arrays(daily, [host], both, as_of).drop("first_found_date")


def host_month_step(prev: DataFrame, events: DataFrame, host: str, user: str, time: str, day: date) -> DataFrame:
    """Add one day to both arrays of every host; absent hosts get zeros.

    Only this month's rows of ``prev`` count; an array that has the day
    already, or lacks an earlier one, is an error.
    """
    pad = _slots_before(day)
    zero = F.lit(0).cast("long")
    t = (
        events.filter(F.to_date(time) == F.lit(day))
        .groupBy(host)
        .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct(user).alias("visitors"))
        .alias("t")
    )
    p = prev.filter(F.col("month_start") == F.lit(day.replace(day=1))).alias("p")

    def grown(array: str, value: str) -> Column:
        old = F.coalesce(_whole(f"p.{array}", day), F.array_repeat(zero, pad))
        return F.concat(old, F.array(F.coalesce(f"t.{value}", zero))).alias(array)

    return p.join(t, F.col(f"p.{host}") == F.col(f"t.{host}"), "full_outer").select(
        F.coalesce(f"p.{host}", f"t.{host}").alias(host),
        F.lit(day.replace(day=1)).alias("month_start"),
        grown("hit_array", "hits"),
        grown("unique_visitors", "visitors"),
    )
