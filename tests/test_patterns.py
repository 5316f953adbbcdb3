from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import as_set, rows
from ledgerline.operators import patterns
from ledgerline.plans import inspect

EVENT = "u int, t timestamp, url string"


@pytest.fixture(scope="module")
def clicks():
    rng = random.Random(11)
    out = []
    for user in (1, 2, None):
        for day in range(3):
            for _ in range(rng.randint(0, 25)):
                minute = rng.randint(0, 1439)
                out.append((user, datetime(2024, 1, 1 + day, minute // 60, minute % 60), rng.choice(["/a", "/b", "/buy"])))
    return out + out[:5]


@pytest.mark.parametrize("include_last", [False, True])
def test_funnel_equals_self_join(spark, clicks, include_last):
    seen = sorted({c for c in clicks if c[0] is not None})
    want = {}
    for u, t, url in seen:
        later = [x for x in seen if x[0] == u and x[1].date() == t.date() and x[1] > t]
        if later or include_last:
            n, hit = want.get(url, (0, 0))
            want[url] = (n + 1, hit + any(x[2] == "/buy" for x in later))
    df = spark.createDataFrame(clicks, EVENT)
    got = rows(patterns.funnel(df, "u", "t", "url", "/buy", include_last=include_last), "url", "n_events", "n_converted")
    assert got == as_set((u, n, h) for u, (n, h) in want.items() if h)


def test_funnel_has_no_quadratic_join(spark, clicks):
    plan = patterns.funnel(spark.createDataFrame(clicks, EVENT), "u", "t", "url", "/buy")
    assert not inspect.has_cross_join(plan) and not inspect.uses_python(plan)


def test_dashboard_levels_each_add_up(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), (None, "y")], "d1 string, d2 string")
    out = patterns.dashboard(df, ["d1", "d2"], [["d1", "d2"], ["d1"], ["d2"], []], {"n": F.count(F.lit(1))})
    totals = dict(rows(out.groupBy("aggregation_level").agg(F.sum("n").alias("n"))))
    assert totals == {"d1__d2": 4, "d1": 4, "d2": 4, "overall": 4}
    assert ("d1", "unknown", "(overall)", 1) in rows(out)


def test_dashboard_groups_before_it_copies(spark):
    df = spark.range(10).select((F.col("id") % 2).cast("string").alias("d1"), F.lit("x").alias("d2"))
    plan = inspect.plan_text(patterns.dashboard(df, ["d1", "d2"], [["d1"], ["d2"]], {"n": F.count(F.lit(1))}))
    # Plans print the root first: the copying sits above the fine aggregate's shuffle.
    assert plan.index("Expand") < plan.index("d1", plan.index("Exchange", plan.index("Expand")))


def test_game_sets_count_team_games_once(spark):
    df = spark.createDataFrame(
        [(1, 7, 2000, 10, 1, True), (2, 7, 2000, 5, 1, True), (1, 8, 2001, 3, 2, False)],
        "player_id int, team_id int, season int, pts int, game_id int, won boolean",
    )
    got = rows(patterns.game_sets(df).filter("aggregation_level = 'team'"), "team_id", "points", "games", "wins")
    assert got == [(7, 15, 1, 1), (8, 3, 1, 0)]
    assert ("player_team", 1, 7, None, 10, 1, 1) in rows(patterns.game_sets(df))
    assert ("player_season", 1, None, 2001, 3, 1, 0) in rows(patterns.game_sets(df))


def daily(spark, n=20, skip=()):
    data = [("k", date(2024, 1, 25) + timedelta(days=i), i + 1) for i in range(n) if i not in skip]
    return spark.createDataFrame(data, "k string, d date, n int")


def test_weeks_do_not_overlap(spark):
    out = patterns.rolling_counts(daily(spark), ["k"], "d", "n")
    last = out.orderBy(F.col("d").desc()).first()
    assert last["weekly_rolling_count"] == sum(range(14, 21))
    assert last["previous_weekly_rolling_count"] == sum(range(7, 14))
    assert last["overall_total"] == last["running_total"] == 210
    assert last["month_total"] == sum(range(8, 21))


def test_calendar_weeks_follow_days_not_rows(spark):
    out = patterns.rolling_counts(daily(spark, skip=(15, 16)), ["k"], "d", "n", calendar=True)
    last = out.orderBy(F.col("d").desc()).first()
    assert last["weekly_rolling_count"] == 14 + 15 + 18 + 19 + 20
    assert last["previous_weekly_rolling_count"] == sum(range(7, 14))


def test_rolling_threshold(spark):
    assert patterns.rolling_counts(daily(spark), ["k"], "d", "n", min_total=210).count() == 0


def test_win_stretch_and_streak(spark):
    rng = random.Random(5)
    results = [rng.randint(0, 1) for _ in range(60)]
    games = spark.createDataFrame(
        [(i, date(2024, 1, 1) + timedelta(days=i // 2), 1, 2, r) for i, r in enumerate(results)],
        "game_id int, game_date date, home_team_id int, visitor_team_id int, home_team_wins int",
    )
    got = dict(rows(patterns.win_stretch(games, 9)))
    sums = [sum(results[i : i + 9]) for i in range(52)]
    assert got == {1: max(sums), 2: 9 - min(sums)}
    points = spark.createDataFrame(
        [(1, i, date(2024, 1, 1) + timedelta(days=i), p) for i, p in enumerate([11, 12, 10, 30, 30, 30, 5])]
        + [(2, 1, date(2024, 1, 1), 3)],
        "player_id int, game_id int, game_date date, pts int",
    )
    assert rows(patterns.scoring_streak(points, 10)) == [(1, 3), (2, 0)]


def test_unit_and_report_profit_agree(spark):
    lines = spark.createDataFrame([(1, 10), (1, -3), (2, 5)], "o int, p int")
    when = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 5))], "o int, d date")
    units = patterns.unit_profit(lines, "o", F.col("p"))
    report = patterns.profit_report(units, when, "o", "d")
    assert units.agg(F.sum("profit")).first()[0] == report.agg(F.sum("profit")).first()[0] == 12
    stale = report.withColumn("profit", F.when(F.month("month_start") == 2, 99).otherwise(F.col("profit")))
    checked = patterns.reconcile(stale, lines, when, "o", "d", F.col("p"))
    assert rows(checked, "line_profit", "agrees") == [(5, False), (7, True)]


def test_growth_and_engagement(spark):
    first = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 1),), (date(2024, 1, 3),)], "day date")
    assert rows(patterns.daily_growth(first, "day"), "n_new", "n_total", "growth_rate") == as_set([(2, 2, None), (1, 3, 0.5)])
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 1, 5)), (None, datetime(2024, 1, 1))], "u int, t timestamp")
    assert rows(patterns.engagement_report(df, "u", "t"), "n_events", "n_users", "events_per_user") == [(2, 1, 2.0)]
