from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows, settled
from ledgerline.operators import activity, arrays, growth
from ledgerline.plans import inspect

START = date(2024, 1, 1)
EVENT = "u int, d int, h string, t timestamp"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    out = []
    for user in range(6):
        for day in range(14):
            if rng.random() < 0.35:
                for _ in range(rng.randint(1, 3)):
                    moment = datetime(2024, 1, 1 + day, rng.randint(0, 23))
                    out.append((user if user else None, rng.randint(0, 2), f"h{rng.randint(0, 1)}", moment))
    return out


@pytest.fixture(scope="module")
def events(spark, data):
    return spark.createDataFrame(data, EVENT).cache()


def days():
    return [START + timedelta(days=i) for i in range(14)]


def test_active_dates_fold_equals_backfill(spark, events):
    state = spark.createDataFrame([], "u int, dates_active array<date>, date date")
    for day in days():
        state = settled(activity.active_dates_step(state, events, ["u"], "t", day))
    assert rows(state) == rows(activity.active_dates_backfill(events, ["u"], "t", days()[-1]))
    assert all(r[0] is not None for r in rows(state))


def test_newest_first(spark, events):
    before = activity.active_dates_backfill(events, ["u"], "t", days()[-2], newest_first=True)
    now = activity.active_dates_step(before, events, ["u"], "t", days()[-1], newest_first=True)
    assert rows(now) == rows(activity.active_dates_backfill(events, ["u"], "t", days()[-1], newest_first=True))


def test_step_refuses_a_gap(spark, events):
    before = activity.active_dates_backfill(events, ["u"], "t", days()[3])
    with pytest.raises(Exception, match="needs the snapshot of 2024-01-05"):
        activity.active_dates_step(before, events, ["u"], "t", days()[5]).collect()


def test_two_part_key(spark, events):
    before = activity.active_dates_backfill(events, ["u", "h"], "t", days()[-2])
    now = activity.active_dates_step(before, events, ["u", "h"], "t", days()[-1])
    assert rows(now) == rows(activity.active_dates_backfill(events, ["u", "h"], "t", days()[-1]))


def test_datelist_flags_and_no_shuffle(spark):
    df = spark.createDataFrame(
        [
            (1, [date(2024, 1, 30)], date(2024, 1, 30)),
            (2, [date(2024, 1, 23)], date(2024, 1, 30)),
            (3, [date(2023, 12, 30), date(2023, 12, 29)], date(2024, 1, 30)),
        ],
        "u int, dates_active array<date>, date date",
    )
    bits = activity.datelist(df, date(2024, 1, 30))
    assert inspect.shuffles(bits) == 0 and not inspect.uses_python(bits)
    got = rows(activity.activity_flags(bits), "u", "l32", "l7", "weekly_active_previous_week", "daily_active", "monthly_active")
    assert got == [(1, 1, 1, False, True, True), (2, 1, 0, True, False, True), (3, 1, 0, False, False, True)]


def test_device_map_round_trip(spark, events):
    devices = spark.createDataFrame([(0, "X"), (1, "X"), (2, "Y")], "d int, b string")
    flat = activity.device_activity(events, devices, "u", "d", "b", "t", days()[-1])
    mapped = activity.as_label_map(flat, "u", "b")
    back = mapped.select("u", F.explode("device_activity_datelist").alias("b", "dates_active"), "date")
    assert rows(back) == rows(flat)
    assert rows(activity.datelist_of_map(mapped, "u", "b", days()[-1])) == rows(activity.datelist(flat, days()[-1]))


# -- month arrays -----------------------------------------------------------

METRIC = "u int, month_start date, metric_name string, metric_array array<bigint>"


def test_array_metric_fold_equals_backfill(spark, events):
    state = spark.createDataFrame([], METRIC)
    for day in days():
        state = arrays.array_metric_step(state, events, "u", "t", "hits", day)
    whole = arrays.array_metric_backfill(events, "u", "t", "hits", days()[-1])
    assert rows(state) == rows(whole)
    assert rows(arrays.array_lengths(whole, "metric_array")) == [(14, whole.count())]


def test_array_metric_refuses_the_same_day_twice(spark, events):
    state = arrays.array_metric_backfill(events, "u", "t", "hits", days()[4])
    with pytest.raises(Exception, match="needs 4 slots"):
        arrays.array_metric_step(state, events, "u", "t", "hits", days()[4]).collect()


def test_array_metric_touches_one_metric(spark, events):
    state = arrays.array_metric_backfill(events, "u", "t", "other", days()[3])
    fresh = arrays.array_metric_step(state, events, "u", "t", "hits", days()[4])
    assert {r["metric_name"] for r in fresh.collect()} == {"hits"}


def test_array_sums_equal_daily_counts(spark, events, data):
    whole = arrays.array_metric_backfill(events, "u", "t", "hits", days()[-1])
    got = dict(rows(arrays.arrays_to_daily(whole, ["metric_name"], "metric_array", "v"), "day", "v"))
    want = {day: sum(1 for u, _, _, t in data if u is not None and t.date() == day) for day in days()}
    assert got == want


def test_monthly_hits_fold_and_first_seen_survives_absence(spark, events):
    state = spark.createDataFrame(
        [], "u int, hit_array array<bigint>, month_start date, first_found_date date, date_partition date"
    )
    for day in days():
        state = settled(arrays.monthly_hits_step(state, events, "u", "t", day))
    assert rows(state) == rows(arrays.monthly_hits_backfill(events, "u", "t", days()[-1]))
    assert state.filter("first_found_date is null").count() == 0


def test_first_days(spark):
    data = [
        ("may", [7, None, 20, 5], "day4"), ("may", [40], "day4"), ("may", [500, 500, 500, 500], "day3"),
        ("june", [None, 9], "day4"), ("july", [], "day4"), ("august", [1], "day3"),
    ]
    df = spark.createDataFrame(data, "month_start string, hits array<bigint>, part string")
    totals = arrays.first_days(df, "hits", "part", "day4", ("d1", "d2", "d3", "d4"))
    assert {r[0]: r[1:] for r in rows(totals)} == {"may": (47, 0, 20, 5), "june": (0, 9, 0, 0), "july": (0, 0, 0, 0)}
    kept = arrays.first_days(df, "hits", "part", "day4", ("d1", "d2"), keep_null=True)
    assert {r[0]: r[1:] for r in rows(kept)} == {"may": (47, None), "june": (None, 9), "july": (None, None)}


def around_a_month_end(spark):
    moments = [(u, 0, f"h{u % 2}", datetime(2024, m, d)) for u, m, d in ((1, 1, 30), (1, 1, 31), (2, 1, 29), (1, 2, 1), (3, 2, 1), (3, 2, 2))]
    return spark.createDataFrame(moments, EVENT)


def test_monthly_hits_start_anew_each_month(spark):
    events = around_a_month_end(spark)
    last = arrays.monthly_hits_backfill(events, "u", "t", date(2024, 1, 31))
    first = arrays.monthly_hits_step(last, events, "u", "t", date(2024, 2, 1))
    assert rows(first, "u", "hit_array", "month_start") == [(1, [1], date(2024, 2, 1)), (3, [1], date(2024, 2, 1))]
    stored = last.unionByName(first)
    second = arrays.monthly_hits_step(stored, events, "u", "t", date(2024, 2, 2))
    assert rows(second) == rows(arrays.monthly_hits_backfill(events, "u", "t", date(2024, 2, 2)))


def test_monthly_hits_refuse_a_repeat_and_a_gap(spark):
    events = around_a_month_end(spark)
    for day in (30, 29, 31):
        state = arrays.monthly_hits_backfill(events, "u", "t", date(2024, 1, day))
        if day != 30:
            with pytest.raises(Exception, match="needs the snapshot of 2024-01-30"):
                arrays.monthly_hits_step(state, events, "u", "t", date(2024, 1, 31)).collect()
    bad = arrays.monthly_hits_backfill(events, "u", "t", date(2024, 1, 29)).withColumn("date_partition", F.lit(date(2024, 1, 30)))
    with pytest.raises(Exception, match="needs 30 slots, found 29"):
        arrays.monthly_hits_step(bad, events, "u", "t", date(2024, 1, 31)).collect()


def test_host_month_refuses_a_repeat_and_starts_anew(spark):
    events = around_a_month_end(spark)
    last = arrays.host_month(events, "h", "u", "t", date(2024, 1, 31))
    with pytest.raises(Exception, match="needs 30 slots, found 31"):
        arrays.host_month_step(last, events, "h", "u", "t", date(2024, 1, 31)).collect()
    first = arrays.host_month_step(last, events, "h", "u", "t", date(2024, 2, 1))
    assert rows(first, "h", "hit_array", "unique_visitors") == [("h1", [2], [2])]


def test_host_month_fold_equals_backfill(spark, events):
    state = spark.createDataFrame(
        [], "h string, month_start date, hit_array array<bigint>, unique_visitors array<bigint>"
    )
    for day in days():
        state = arrays.host_month_step(state, events, "h", "u", "t", day)
    whole = arrays.host_month(events, "h", "u", "t", days()[-1])
    assert rows(state, *whole.columns) == rows(whole)


# -- growth -----------------------------------------------------------------

GROWTH = (
    "u int, first_active_date date, last_active_date date, daily_active_state string, weekly_active_state string, "
    "dates_active array<date>, date date"
)


def test_growth_fold_equals_backfill(spark, events):
    whole = growth.growth_backfill(events, "u", "t", days()[-1])
    state = spark.createDataFrame([], GROWTH)
    for day in days():
        state = settled(growth.growth_step(state, events, "u", "t", day))
        assert rows(state, *whole.columns) == rows(whole.filter(F.col("date") == F.lit(day)))


def test_one_day_equals_the_last_of_all(spark, events):
    for day in (days()[6], days()[-1]):
        whole = growth.growth_backfill(events, "u", "t", day).filter(F.col("date") == F.lit(day))
        assert rows(growth.growth_backfill(events, "u", "t", day, only_last=True), *whole.columns) == rows(whole)


def test_daily_states(spark):
    seen = [1, 2, 4]
    df = spark.createDataFrame([(1, 0, "h", datetime(2024, 1, d)) for d in seen], EVENT)
    got = [s for _, s in rows(growth.growth_backfill(df, "u", "t", date(2024, 1, 6)), "date", "daily_active_state")]
    assert got == ["New", "Retained", "Churned", "Resurrected", "Churned", "Stale"]


def test_weekly_states(spark):
    df = spark.createDataFrame([(1, 0, "h", datetime(2024, 1, d)) for d in (1, 20)], EVENT)
    got = dict(rows(growth.growth_backfill(df, "u", "t", date(2024, 1, 21)), "date", "weekly_active_state"))
    assert got[date(2024, 1, 8)] == "Retained"
    assert got[date(2024, 1, 9)] == "Churned"
    assert got[date(2024, 1, 10)] == "Stale"
    assert got[date(2024, 1, 20)] == "Resurrected"


def test_retention_starts_at_one(spark, events):
    got = rows(growth.retention(growth.growth_backfill(events, "u", "t", days()[-1], with_dates=False)))
    assert got[0][:2] == (0, 1.0)


def test_growth_shuffles_detail_rows_once(spark, events):
    """Distinct (user, day), then one shuffle by user: nothing else moves."""
    assert inspect.shuffles(growth.growth_backfill(events, "u", "t", days()[-1])) <= 2
