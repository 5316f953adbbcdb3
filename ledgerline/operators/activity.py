"""Active-day lists per entity, their 32-day bit form and the flags read from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    DATELIST_WIDTH,
    DAY_MASK,
    PREVIOUS_WEEK_MASK,
    WEEK_MASK,
    bits_of_dates,
    days_in_mask,
    empty_array,
)
from ledgerline.operators.steps import snapshot_before


def active_days(events: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Distinct (keys, day); rows with a null key part are left out before the shuffle."""
    kept = events
    for key in keys:
        kept = kept.filter(F.col(key).isNotNull())
    return kept.select(*keys, F.to_date(time).alias("day")).distinct()


def active_dates_step(
    prev: DataFrame, events: DataFrame, keys: Sequence[str], time: str, day: date, newest_first: bool = False
) -> DataFrame:
    """Yesterday's lists plus one day of events; lists only grow for active entities.

    Of a stored table of many days only yesterday's rows are read.
    """
    today = active_days(events.filter(F.to_date(time) == F.lit(day)), keys, time).alias("t")
    p = snapshot_before(prev, "date", day - timedelta(days=1)).alias("p")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"p.{key}") == F.col(f"t.{key}"))
    old = F.coalesce("p.dates_active", empty_array("date"))
    new = F.when(F.col("t.day").isNotNull(), F.array("t.day")).otherwise(empty_array("date"))
    both = F.concat(new, old) if newest_first else F.concat(old, new)
    return p.join(today, on, "full_outer").select(
        *[F.coalesce(f"p.{k}", f"t.{k}").alias(k) for k in keys],
        both.alias("dates_active"),
        F.lit(day).alias("date"),
    )


def active_dates_backfill(
    events: DataFrame, keys: Sequence[str], time: str, as_of: date, newest_first: bool = False
) -> DataFrame:
    """The lists as of one day in a single pass; equal to repeating the step."""
    days = active_days(events.filter(F.to_date(time) <= F.lit(as_of)), keys, time)
    lists = F.sort_array(F.collect_list("day"), asc=not newest_first)
    return days.groupBy(*keys).agg(lists.alias("dates_active")).withColumn("date", F.lit(as_of))


def datelist(df: DataFrame, as_of: date, width: int = DATELIST_WIDTH) -> DataFrame:
    """Replace the date list by its bits; no join with a calendar."""
    bits = bits_of_dates(F.col("dates_active"), F.lit(as_of), width)
    keep = [c for c in df.columns if c not in ("dates_active", "date")]
    return df.select(*keep, bits.alias("datelist_int"), F.lit(as_of).alias("date"))


def activity_flags(df: DataFrame, bits: str = "datelist_int") -> DataFrame:
    """Monthly, weekly, previous-week and daily activity from the bits."""
    b = F.col(bits)
    l32 = F.bit_count(b).cast("long")
    l7 = days_in_mask(b, WEEK_MASK)
    return df.select(
        "*",
        (l32 > 0).alias("monthly_active"),
        l32.alias("l32"),
        (l7 > 0).alias("weekly_active"),
        l7.alias("l7"),
        (days_in_mask(b, PREVIOUS_WEEK_MASK) > 0).alias("weekly_active_previous_week"),
        (days_in_mask(b, DAY_MASK) > 0).alias("daily_active"),
    )


def device_activity(
    events: DataFrame, devices: DataFrame, user: str, device: str, label: str, time: str, as_of: date
) -> DataFrame:
    """Active days per user and device label, e.g. browser.

    Events shrink to distinct (user, device, day) before they meet the devices.
    """
    days = active_days(events.filter(F.to_date(time) <= F.lit(as_of)), [user, device], time)
    labelled = days.join(devices.select(device, label), device).select(user, label, "day").distinct()
    return (
        labelled.groupBy(user, label)
        .agg(F.sort_array(F.collect_list("day")).alias("dates_active"))
        .withColumn("date", F.lit(as_of))
    )


def as_label_map(df: DataFrame, user: str, label: str) -> DataFrame:
    """One row per user: map from label to its date list."""
    entry = F.struct(F.col(label), F.col("dates_active"))
    return df.groupBy(user, "date").agg(
        F.map_from_entries(F.collect_list(entry)).alias("device_activity_datelist")
    )


def datelist_of_map(df: DataFrame, user: str, label: str, as_of: date) -> DataFrame:
    """Bits per user and label from the map form."""
    rows = df.select(user, F.explode("device_activity_datelist").alias(label, "dates_active"), "date")
    return datelist(rows, as_of)
