"""Growth accounting, retention and activity state changes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import empty_array, ratio
from ledgerline.operators.activity import active_days
from ledgerline.operators.spine import period_spine
from ledgerline.operators.steps import snapshot_before

# Daily states that count as active in a retention curve.
ACTIVE_STATES = ("Retained", "Resurrected", "New")


def daily_state(known: Column, today: Column, last: Column, yesterday: Column) -> Column:
    """State against the last active date; ``known`` false means no earlier row."""
    return (
        F.when(~known, "New")
        .when(F.datediff(today, last) == 1, "Retained")
        .when(F.datediff(today, last) > 1, "Resurrected")
        .when(today.isNull() & (last == yesterday), "Churned")
        .otherwise("Stale")
    )


def weekly_state(known: Column, today: Column, last: Column, yesterday: Column) -> Column:
    return (
        F.when(~known, "New")
        .when(F.datediff(today, last) > 7, "Resurrected")
        .when(today.isNull() & (F.datediff(yesterday, last) == 7), "Churned")
        .when(F.datediff(yesterday, F.coalesce(today, last)) <= 7, "Retained")
        .otherwise("Stale")
    )


def growth_step(prev: DataFrame, events: DataFrame, user: str, time: str, day: date) -> DataFrame:
    """Yesterday's user states and one day of events make today's states.

    Of a stored table of many days only yesterday's rows are read.
    """
    t = active_days(events.filter(F.to_date(time) == F.lit(day)), [user], time).alias("t")
    y = snapshot_before(prev, "date", day - timedelta(days=1)).alias("y")
    known, today = F.col(f"y.{user}").isNotNull(), F.col("t.day")
    last, yesterday = F.col("y.last_active_date"), F.col("y.date")
    fresh = F.when(today.isNotNull(), F.array(today)).otherwise(empty_array("date"))
    return y.join(t, F.col(f"y.{user}") == F.col(f"t.{user}"), "full_outer").select(
        F.coalesce(f"y.{user}", f"t.{user}").alias(user),
        F.coalesce("y.first_active_date", "t.day").alias("first_active_date"),
        F.coalesce("t.day", "y.last_active_date").alias("last_active_date"),
        daily_state(known, today, last, yesterday).alias("daily_active_state"),
        weekly_state(known, today, last, yesterday).alias("weekly_active_state"),
        F.concat(F.coalesce("y.dates_active", empty_array("date")), fresh).alias("dates_active"),
        F.lit(day).alias("date"),
    )


def growth_backfill(
    events: DataFrame, user: str, time: str, as_of: date, with_dates: bool = True, only_last: bool = False
) -> DataFrame:
    """Every user's state on every day up to ``as_of``, or just on that day, in one pass.

    Equal to repeating the step from an empty table. Events shrink to distinct
    (user, day) before the one shuffle by user.
    """
    days = active_days(events.filter(F.to_date(time) <= F.lit(as_of)), [user], time)
    spine = period_spine(days, [user], "day", F.lit(as_of), only_last=only_last)
    date_col = F.col("day")
    active = F.col("is_active")
    known = ~(active & (F.col("_i") == 0))
    today = F.when(active, date_col)
    last = F.when(active, F.col("_before._p")).otherwise(F.col("_now._p"))
    yesterday = F.date_sub(date_col, 1)
    columns = [
        F.col(user),
        F.col("_first").alias("first_active_date"),
        F.col("_now._p").alias("last_active_date"),
        daily_state(known, today, last, yesterday).alias("daily_active_state"),
        weekly_state(known, today, last, yesterday).alias("weekly_active_state"),
    ]
    if with_dates:
        so_far = F.slice("_all", 1, F.col("_i") + 1)
        columns.append(F.transform(so_far, lambda e: e["_p"]).alias("dates_active"))
    return spine.select(*columns, date_col.alias("date"))


def retention(states: DataFrame) -> DataFrame:
    """Share of users active by days since their first active day."""
    age = F.datediff("date", "first_active_date").cast("long")
    return (
        states.groupBy(age.alias("days_since_first_active"))
        .agg(
            F.count_if(F.col("daily_active_state").isin(*ACTIVE_STATES)).alias("n_active"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("days_since_first_active", ratio(F.col("n_active"), F.col("n")).alias("pct_active"), "n")
    )


def state_changes(snapshots: DataFrame, key: str, period: str, active: str) -> DataFrame:
    """Career state of each snapshot row; unique on (key, period)."""
    before = F.lag(active).over(Window.partitionBy(key).orderBy(period))
    now = F.col(active)
    state = (
        F.when(before.isNull() & now, "New")
        .when(before & ~now, "Retired")
        .when(before & now, "Continued Playing")
        .when(~before & now, "Returned from Retirement")
        .otherwise("Stayed Retired")
    )
    return snapshots.select(key, period, active, state.alias("state"))
