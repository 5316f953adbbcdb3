"""Funnels, grouping-set dashboards, rolling counts, streaks and KPI roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio
from ledgerline.operators.grouping import dedupe
from ledgerline.operators.ordered import chunked, longest_run, stretch_best

OVERALL = "(overall)"
UNKNOWN = "unknown"


def funnel(
    events: DataFrame,
    user: str,
    time: str,
    url: str,
    target: str,
    min_events: int = 0,
    include_last: bool = False,
    slice_minutes: int = 10,
) -> DataFrame:
    """Per url: events followed later the same day by ``target``, and their share.

    No self-join: an event is followed by the target exactly when the user's
    last target that day is later. The last times are found per user, day and
    slice of the day, then over the slices, and joined back per slice, so a
    user with a large part of all rows is spread over days and slices. The last
    event of a user's day has nothing after it and does not count, unless
    ``include_last``.
    """
    seen = events.filter(F.col(user).isNotNull()).select(user, time, url).distinct()
    second = F.unix_seconds(F.col(time))
    placed = seen.select(
        user,
        F.col(time).alias("_t"),
        url,
        F.to_date(time).alias("_day"),
        F.floor(second / (60 * slice_minutes)).alias("_slice"),
    )
    marks = placed.groupBy(user, "_day", "_slice").agg(
        F.max("_t").alias("_last"), F.max(F.when(F.col(url) == target, F.col("_t"))).alias("_target")
    )
    day = Window.partitionBy(user, "_day")
    marks = marks.select(
        user, "_day", "_slice", F.max("_last").over(day).alias("_last"), F.max("_target").over(day).alias("_target")
    )
    joined = placed.join(marks, [user, "_day", "_slice"])
    if not include_last:
        joined = joined.filter(F.col("_last") > F.col("_t"))
    return (
        joined.groupBy(url)
        .agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("_target") > F.col("_t")).alias("n_converted"))
        .withColumn("conversion", ratio(F.col("n_converted"), F.col("n_events")))
        .filter((F.col("n_converted") > 0) & (F.col("n_events") > min_events))
    )


def level_label(dims: Sequence[str], tested: Sequence[str], combined: str) -> Column:
    """Name of a grouping level: all present, else the first present of ``tested``."""
    label: Column = F.lit(None).cast("string")
    for name in reversed(tested):
        label = F.when(F.grouping(name) == 0, F.lit(name)).otherwise(label)
    every = F.lit(True)
    for name in dims:
        every = every & (F.grouping(name) == 0)
    return F.when(every, F.lit(combined)).otherwise(label)


def dashboard(
    df: DataFrame,
    dims: Sequence[str],
    levels: Sequence[Sequence[str]],
    measures: dict[str, Column],
    combined: str | None = None,
) -> DataFrame:
    """Grouping sets over string dimensions with additive measures.

    Nulls become ``unknown`` first, so a null after grouping means the level
    does not use that dimension. Rows are counted up at the finest grain
    before they are copied once per level; ``measures`` must add up (counts,
    sums).
    """
    named = df.withColumns({d: F.coalesce(F.col(d).cast("string"), F.lit(UNKNOWN)) for d in dims})
    fine = named.groupBy(*dims).agg(*[m.alias(n) for n, m in measures.items()])
    label = level_label(dims, dims, combined or "__".join(dims))
    grouped = fine.groupingSets([[F.col(c) for c in level] for level in levels], *[F.col(d) for d in dims])
    sums = [F.sum(n).alias(n) for n in measures]
    out = grouped.agg(F.coalesce(label, F.lit("overall")).alias("aggregation_level"), *sums)
    return out.select(
        "aggregation_level", *[F.coalesce(F.col(d), F.lit(OVERALL)).alias(d) for d in dims], *measures
    )


def game_sets(appearances: DataFrame) -> DataFrame:
    """Points, games and wins by (player, team), (player, season) and (team).

    ``appearances`` is unique on (player, game) with a ``won`` flag and is read
    once: the grouping sets make the two player levels and one row per team and
    game, which are then added up per team, so a team's many players do not
    multiply its games.
    """
    player, team, season, game = (F.col(c) for c in ("player_id", "team_id", "season", "game_id"))
    kind = (
        F.when(F.grouping("game_id") == 0, "team")
        .when(F.grouping("season") == 0, "player_season")
        .otherwise("player_team")
    )
    sets = appearances.groupingSets([[player, team], [player, season], [team, game]], player, team, season, game).agg(
        kind.alias("aggregation_level"),
        F.sum("pts").alias("points"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("won").alias("_wins"),
    )
    per_game = F.col("aggregation_level") == "team"
    games = F.when(per_game, F.lit(1)).otherwise(F.col("_rows"))
    wins = F.when(per_game, (F.col("_wins") > 0).cast("long")).otherwise(F.col("_wins"))
    return sets.groupBy("aggregation_level", "player_id", "team_id", "season").agg(
        F.sum("points").alias("points"), F.sum(games).alias("games"), F.sum(wins).alias("wins")
    )


def game_set_winners(sets: DataFrame) -> DataFrame:
    """Most points for one team, most points in one season and most wins of a team; ties go to the lowest ids.

    Each is one row of ``game_sets``, found by a maximum, not by a sort.
    """
    asked = (("most points for a team", "player_team", "points"), ("most points in a season", "player_season", "points"), ("most wins", "team", "wins"))
    question = F.lit(None).cast("string")
    amount = F.lit(None).cast("long")
    for name, level, value in asked:
        question = F.when(F.col("aggregation_level") == level, F.lit(name)).otherwise(question)
        amount = F.when(F.col("aggregation_level") == level, F.col(value).cast("long")).otherwise(amount)
    ids = ["player_id", "team_id", "season"]
    order = F.struct(amount, *[-F.coalesce(c, F.lit(0)) for c in ids])
    best = sets.groupBy(question.alias("question")).agg(F.max_by(F.struct(*ids), order).alias("_who"), F.max(amount).alias("amount"))
    return best.select("question", "_who.*", "amount")


def rolling_counts(
    daily: DataFrame,
    keys: Sequence[str],
    day: str,
    count: str,
    min_total: int = 0,
    calendar: bool = False,
    week: int = 7,
) -> DataFrame:
    """Month total, running total, overall total, this and previous week per key.

    ``daily`` is unique on (keys, day), so a key has no more rows than there
    are days. Weeks are rows, or calendar days with ``calendar``.
    """
    base = Window.partitionBy(*keys)
    in_order = base.orderBy(day)
    if calendar:
        by_number = base.orderBy(F.unix_date(day))
        this_week, last_week = by_number.rangeBetween(1 - week, 0), by_number.rangeBetween(1 - 2 * week, -week)
    else:
        this_week, last_week = in_order.rowsBetween(1 - week, 0), in_order.rowsBetween(1 - 2 * week, -week)
    total = F.sum(count)
    out = daily.select(
        *keys,
        day,
        count,
        total.over(Window.partitionBy(*keys, F.trunc(day, "MM"))).alias("month_total"),
        total.over(in_order).alias("running_total"),
        total.over(base).alias("overall_total"),
        total.over(this_week).alias("weekly_rolling_count"),
        total.over(last_week).alias("previous_weekly_rolling_count"),
    )
    return out.filter(F.col("overall_total") > min_total).select(
        "*",
        ratio(F.col(count), F.col("month_total")).alias("pct_of_month"),
        ratio(F.col(count), F.col("overall_total")).alias("pct_of_total"),
    )


def team_games(games: DataFrame) -> DataFrame:
    """Two rows per game, one for each side, with a ``won`` flag."""
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), (F.col("home_team_wins") == 1).alias("won")),
        F.struct(F.col("visitor_team_id").alias("team_id"), (F.col("home_team_wins") == 0).alias("won")),
    )
    return games.select("game_id", "game_date", F.inline(sides))


def win_stretch(games: DataFrame, length: int = 90) -> DataFrame:
    """Most wins of each team in any ``length`` games in a row."""
    rows = chunked(team_games(games), ["team_id"], "game_date", "game_id")
    won = F.col("won").cast("int")
    return stretch_best(rows, ["team_id"], "_chunk", ["game_date", "game_id"], won, length, "most_wins")


def scoring_streak(appearances: DataFrame, above: int = 10) -> DataFrame:
    """Most games in a row in which each player scored more than ``above``."""
    rows = chunked(appearances, ["player_id"], "game_date", "game_id")
    hit = F.col("pts") > above
    return longest_run(rows, ["player_id"], "_chunk", ["game_date", "game_id"], hit, "longest_streak")


def one_per_game(details: DataFrame) -> DataFrame:
    """Details unique on (player, game): lowest team, then points, then position."""
    columns = ["player_id", "game_id", "team_id", "team_abbreviation", "pts", "start_position"]
    return dedupe(details.select(*columns), columns[:2], columns[2:])


def appearances(details: DataFrame, games: DataFrame) -> DataFrame:
    """``one_per_game`` with the game's season, date and result."""
    g = games.select("game_id", "game_date", "season", "home_team_id", "home_team_wins")
    at_home = F.col("team_id") == F.col("home_team_id")
    return one_per_game(details).join(g, "game_id").withColumn("won", at_home == (F.col("home_team_wins") == 1))


def unit_profit(lines: DataFrame, unit: str, profit: Column) -> DataFrame:
    """Profit of each unit, at the grain experiments join to."""
    return lines.groupBy(unit).agg(F.sum(profit).alias("profit"), F.count(F.lit(1)).alias("n_lines"))


def profit_report(units: DataFrame, unit_dates: DataFrame, unit: str, day: str) -> DataFrame:
    """Profit per month, added up from the unit level so that both always agree."""
    return (
        units.join(unit_dates.select(unit, day), unit)
        .groupBy(F.trunc(day, "MM").alias("month_start"))
        .agg(F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_units"))
    )


def reconcile(report: DataFrame, lines: DataFrame, unit_dates: DataFrame, unit: str, day: str, profit: Column) -> DataFrame:
    """A stored monthly report next to the same months added up line by line, without the unit level."""
    direct = (
        lines.join(unit_dates.select(unit, day), unit)
        .groupBy(F.trunc(day, "MM").alias("month_start"))
        .agg(F.sum(profit).alias("line_profit"))
    )
    return report.join(direct, "month_start", "full_outer").withColumn(
        "agrees", F.col("profit").eqNullSafe(F.col("line_profit"))
    )


def daily_growth(first_seen: DataFrame, day: str) -> DataFrame:
    """New entities per day, the running total and growth over the day before."""
    per_day = first_seen.groupBy(day).agg(F.count(F.lit(1)).alias("n_new"))
    in_order = Window.orderBy(day)  # one row per calendar day
    running = per_day.withColumn("n_total", F.sum("n_new").over(in_order))
    before = F.col("n_total") - F.col("n_new")
    return running.withColumn("growth_rate", F.when(before > 0, F.col("n_new") / before))


def engagement_report(events: DataFrame, user: str, time: str) -> DataFrame:
    """Events, active users and events per active user for each day."""
    return (
        events.filter(F.col(user).isNotNull())
        .groupBy(F.to_date(time).alias("day"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct(user).alias("n_users"))
        .withColumn("events_per_user", ratio(F.col("n_events"), F.col("n_users")))
    )
