"""Funnel, dashboards, rolling counts, streaks, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.q_dims import states
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.functions.columns import channel
from ledgerline.operators import growth, patterns
from ledgerline.session import scratch_path
from ledgerline.sources.files import write_partitioned

CHANNEL_SQL = """CASE WHEN contains(referrer, 'linkedin') THEN 'Linkedin' WHEN contains(referrer, 't.co') THEN 'Twitter'
        WHEN contains(referrer, 'google') THEN 'Google' WHEN contains(referrer, 'lnkd') THEN 'Linkedin' ELSE referrer END"""


@query(
    "a3_state_change",
    using(
        """SELECT player_name, current, is_active, CASE
            WHEN was IS NULL AND is_active THEN 'New' WHEN was AND NOT is_active THEN 'Retired'
            WHEN was AND is_active THEN 'Continued Playing' WHEN NOT was AND is_active THEN 'Returned from Retirement'
            ELSE 'Stayed Retired' END AS state
        FROM (SELECT *, lag(is_active) OVER (PARTITION BY player_name ORDER BY current) AS was FROM snapshots)""",
        "snapshots",
    ),
)
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth.state_changes(states(spark, sf_dir), "player_name", "current", "is_active")


@query(
    "a4_funnel",
    using(
        """SELECT url, count(*) AS n_events, count(*) FILTER (hit) AS n_converted,
            round(CAST(count(*) FILTER (hit) AS DOUBLE) / count(*), 6) AS conversion
        FROM (SELECT e.url, EXISTS (SELECT 1 FROM hits h WHERE h.user_id = e.user_id AND h.day = e.day
                                    AND h.event_time > e.event_time AND h.url = '/signup') AS hit
              FROM hits e WHERE EXISTS (SELECT 1 FROM hits h WHERE h.user_id = e.user_id AND h.day = e.day
                                        AND h.event_time > e.event_time))
        GROUP BY url HAVING count(*) FILTER (hit) > 0 AND count(*) > 100""",
        "hits",
    ),
)
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.funnel(views.web_events(spark, sf_dir), "user_id", "event_time", "url", "/signup", min_events=100)


DIMS = ("os_type", "device_type", "browser_type")
AUGMENTED = """(SELECT coalesce(os_type, 'unknown') AS os_type, coalesce(device_type, 'unknown') AS device_type,
        coalesce(browser_type, 'unknown') AS browser_type FROM web_events JOIN devices USING (device_id))"""


def one_level(label: str, *shown: str) -> str:
    """Hits by the shown dimensions alone; the others read ``(overall)``."""
    columns = ", ".join(d if d in shown else f"'(overall)' AS {d}" for d in DIMS)
    return f"SELECT '{label}' AS aggregation_level, {columns}, count(*) AS number_of_hits FROM {AUGMENTED} GROUP BY ALL"


def hits_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per device id, counted before they meet the devices, with the device's dimensions."""
    hits = views.web_events(spark, sf_dir).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    return hits.join(views.devices(spark, sf_dir), "device_id")


@query(
    "a5_grouping_sets",
    using(
        " UNION ALL ".join(
            [one_level("os_type__device_type__browser", *DIMS)] + [one_level(d, d) for d in DIMS]
        ),
        "web_events",
        "devices",
    ),
)
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = [DIMS, ["browser_type"], ["os_type"], ["device_type"]]
    out = patterns.dashboard(
        hits_by_device(spark, sf_dir), DIMS, levels, {"number_of_hits": F.sum("n")}, "os_type__device_type__browser"
    )
    return out.orderBy(F.col("number_of_hits").desc())


@query(
    "a6_game_sets",
    using(
        """SELECT 'player_team' AS aggregation_level, player_id, team_id, CAST(NULL AS BIGINT) AS season,
            CAST(sum(pts) AS BIGINT) AS points, count(*) AS games, count(*) FILTER (won) AS wins FROM appearances GROUP BY player_id, team_id
        UNION ALL SELECT 'player_season', player_id, NULL, season, CAST(sum(pts) AS BIGINT), count(*), count(*) FILTER (won)
            FROM appearances GROUP BY player_id, season
        UNION ALL SELECT 'team', NULL, team_id, NULL, CAST(sum(pts) AS BIGINT), count(DISTINCT game_id),
            count(DISTINCT CASE WHEN won THEN game_id END) FROM appearances GROUP BY team_id""",
        "appearances",
    ),
)
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.game_sets(patterns.appearances(views.game_details(spark, sf_dir, by_game=True), views.games(spark, sf_dir)))


@query(
    "a6_winners",
    using(
        """SELECT * FROM (
        (SELECT 'most points for a team' AS question, player_id, team_id, CAST(NULL AS BIGINT) AS season, CAST(sum(pts) AS BIGINT) AS amount
            FROM appearances GROUP BY 2, 3 ORDER BY 5 DESC, 2, 3 LIMIT 1)
        UNION ALL (SELECT 'most points in a season', player_id, NULL, season, CAST(sum(pts) AS BIGINT)
            FROM appearances GROUP BY 2, 4 ORDER BY 5 DESC, 2, 4 LIMIT 1)
        UNION ALL (SELECT 'most wins', NULL, team_id, NULL, count(DISTINCT CASE WHEN won THEN game_id END)
            FROM appearances GROUP BY 3 ORDER BY 5 DESC, 3 LIMIT 1))""",
        "appearances",
    ),
)
def a6_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = patterns.appearances(views.game_details(spark, sf_dir, by_game=True), views.games(spark, sf_dir))
    return patterns.game_set_winners(patterns.game_sets(rows))


@query(
    "a7_own_site",
    using(
        f"""SELECT CASE WHEN contains(referrer, 'blog.example.net') OR contains(referrer, 'news.example.org') THEN 'On Site'
            ELSE {CHANNEL_SQL} END AS channel, count(*) AS n FROM web_events GROUP BY 1""",
        "web_events",
    ),
)
def a7_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits that come from the operator's own hosts are a channel of their own."""
    own = channel(F.col("referrer"), own_hosts=("blog.example.net", "news.example.org"))
    return views.web_events(spark, sf_dir).groupBy(own.alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a7_referrer",
    using(
        f"SELECT {CHANNEL_SQL} AS channel, referrer, count(*) AS n FROM web_events GROUP BY 1, 2",
        "web_events",
    ),
)
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.web_events(spark, sf_dir)
    return rows.groupBy(channel(F.col("referrer")).alias("channel"), "referrer").agg(F.count(F.lit(1)).alias("n"))


DAILY = f"""(SELECT {CHANNEL_SQL} AS channel, url, CAST(event_time AS DATE) AS event_date, count(*) AS count
        FROM web_events JOIN devices USING (device_id) WHERE referrer IS NOT NULL GROUP BY 1, 2, 3)"""


def rolling_sql(position: str) -> str:
    """Sums by joining each day to the days at a distance; ``position`` numbers the days."""
    return using(
        f"""SELECT channel, url, CAST(event_date AS VARCHAR) AS event_date, count, month_total, running_total, overall_total,
            weekly_rolling_count, previous_weekly_rolling_count,
            round(CAST(count AS DOUBLE) / month_total, 6) AS pct_of_month, round(CAST(count AS DOUBLE) / overall_total, 6) AS pct_of_total
        FROM (SELECT a.channel, a.url, a.event_date, a.count,
                CAST(sum(b.count) FILTER (date_trunc('month', b.event_date) = date_trunc('month', a.event_date)) AS BIGINT) AS month_total,
                CAST(sum(b.count) FILTER (b.pos <= a.pos) AS BIGINT) AS running_total, CAST(sum(b.count) AS BIGINT) AS overall_total,
                CAST(sum(b.count) FILTER (a.pos - b.pos BETWEEN 0 AND 6) AS BIGINT) AS weekly_rolling_count,
                CAST(sum(b.count) FILTER (a.pos - b.pos BETWEEN 7 AND 13) AS BIGINT) AS previous_weekly_rolling_count
              FROM (SELECT *, {position} AS pos FROM {DAILY}) a JOIN (SELECT *, {position} AS pos FROM {DAILY}) b ON a.channel = b.channel AND a.url = b.url GROUP BY 1, 2, 3, 4)
        WHERE overall_total > 100""",
        "web_events",
        "devices",
    )


def daily_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of known devices with a referrer; others do not count."""
    known = views.devices(spark, sf_dir).select("device_id")
    rows = views.web_events(spark, sf_dir).filter(F.col("referrer").isNotNull()).join(known, "device_id", "left_semi")
    keys = [channel(F.col("referrer")).alias("channel"), F.col("url"), F.to_date("event_time").alias("event_date")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


@query(
    "a8_rolling",
    rolling_sql("row_number() OVER (PARTITION BY channel, url ORDER BY event_date)"),
)
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.rolling_counts(daily_channels(spark, sf_dir), ["channel", "url"], "event_date", "count", 100)


@query(
    "a8_rolling_calendar",
    rolling_sql("event_date - DATE '2024-01-01'"),
)
def a8_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_channels(spark, sf_dir)
    return patterns.rolling_counts(daily, ["channel", "url"], "event_date", "count", 100, calendar=True)


@query(
    "a9_win_stretch",
    using(
        """SELECT team_id, CAST(max(w) AS BIGINT) AS most_wins FROM (
            SELECT team_id, sum(won) OVER s AS w, count(*) OVER s AS n FROM (
                SELECT home_team_id AS team_id, game_id, game_date, CASE WHEN home_team_wins = 1 THEN 1 ELSE 0 END AS won FROM games
                UNION ALL SELECT visitor_team_id, game_id, game_date, CASE WHEN home_team_wins = 0 THEN 1 ELSE 0 END FROM games)
            WINDOW s AS (PARTITION BY team_id ORDER BY game_date, game_id ROWS BETWEEN 89 PRECEDING AND CURRENT ROW))
        WHERE n = 90 GROUP BY team_id""",
        "games",
    ),
)
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.win_stretch(views.games(spark, sf_dir), 90)


@query(
    "a10_longest_streak",
    using(
        """SELECT player_id, max(len) AS longest_streak FROM (
            SELECT player_id, grp, count(*) FILTER (pts > 10) AS len FROM (
                SELECT player_id, pts, sum(CASE WHEN pts > 10 THEN 0 ELSE 1 END)
                       OVER (PARTITION BY player_id ORDER BY game_date, game_id) AS grp FROM appearances)
            GROUP BY 1, 2) GROUP BY 1""",
        "appearances",
    ),
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = patterns.appearances(views.game_details(spark, sf_dir, by_game=True), views.games(spark, sf_dir))
    return patterns.scoring_streak(rows, 10)


MATCH_ROWS = "(SELECT d.*, playlist_id, CAST(mapid AS VARCHAR) AS mapid, CAST(year(completion_date) AS VARCHAR) AS season FROM match_details d JOIN matches USING (match_id))"


def match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per match with the match's dimensions."""
    totals = views.match_details(spark, sf_dir).groupBy("match_id").agg(
        F.sum("player_total_kills").alias("kills"),
        F.sum("player_total_deaths").alias("deaths"),
        F.count(F.lit(1)).alias("appearances"),
    )
    season = F.year("completion_date").cast("string").alias("season")
    m = views.matches(spark, sf_dir).select("match_id", "playlist_id", F.col("mapid").cast("string").alias("mapid"), season)
    return totals.join(m, "match_id")


def match_measures() -> dict[str, Column]:
    return {name: F.sum(name) for name in ("kills", "deaths", "appearances")}


@query(
    "a11_extract",
    using(
        f"""SELECT CASE WHEN grouping(playlist_id) = 0 THEN 'playlist_id' WHEN grouping(season) = 0 THEN 'season' ELSE 'overall' END AS aggregation_level,
            coalesce(playlist_id, '(overall)') AS playlist_id, coalesce(season, '(overall)') AS season,
            CAST(sum(player_total_kills) AS BIGINT) AS kills, CAST(sum(player_total_deaths) AS BIGINT) AS deaths, count(*) AS appearances
        FROM {MATCH_ROWS} GROUP BY GROUPING SETS ((), (playlist_id), (season))""",
        "matches",
        "match_details",
    ),
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executive extract, written out and read back as a dashboard tool would."""
    rows = match_rows(spark, sf_dir)
    out = patterns.dashboard(rows, ["playlist_id", "season"], [[], ["playlist_id"], ["season"]], match_measures())
    path = write_partitioned(out, scratch_path(spark, "extract"), ["aggregation_level"])
    return spark.read.schema(out.schema).parquet(path)


@query(
    "a11_explore",
    using(
        f"""SELECT 'playlist_id__mapid__season' AS aggregation_level, playlist_id, mapid, season,
            CAST(sum(player_total_kills) AS BIGINT) AS kills, CAST(sum(player_total_deaths) AS BIGINT) AS deaths, count(*) AS appearances
        FROM {MATCH_ROWS} GROUP BY 2, 3, 4""",
        "matches",
        "match_details",
    ),
)
def a11_explore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploratory extract: every filter dimension at once."""
    dims = ["playlist_id", "mapid", "season"]
    return patterns.dashboard(match_rows(spark, sf_dir), dims, [dims], match_measures())


LINE_PROFIT = """CAST(round(l_extendedprice * 100) AS BIGINT)
        * (100 - CAST(round(l_discount * 100) AS BIGINT) - CAST(round(l_tax * 100) AS BIGINT))"""


def line_profit() -> Column:
    """Hundredths of a cent: price less discount and tax."""
    return views.cents("l_extendedprice") * (F.lit(100) - views.cents("l_discount") - views.cents("l_tax"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit per order."""
    return patterns.unit_profit(views.order_lines(spark, sf_dir), "l_orderkey", line_profit())


@query(
    "a12_unit_profit",
    f"SELECT l_orderkey, CAST(sum({LINE_PROFIT}) AS BIGINT) AS profit, count(*) AS n_lines FROM lineitem GROUP BY 1",
)
def a12_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir)


@query(
    "a12_profit",
    f"""SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
        CAST(sum({LINE_PROFIT}) AS BIGINT) AS profit, count(DISTINCT l_orderkey) AS n_units
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def a12_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.profit_report(units(spark, sf_dir), views.orders_by_day(spark, sf_dir), "l_orderkey", "order_day")


@query(
    "a12_kpis",
    f"""SELECT month_start, r.profit, d.profit AS line_profit, n_units, r.profit IS NOT DISTINCT FROM d.profit AS agrees
        FROM (SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
                     CAST(sum(p) AS BIGINT) AS profit, count(*) AS n_units
              FROM (SELECT l_orderkey, sum({LINE_PROFIT}) AS p FROM lineitem GROUP BY 1) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) r
        FULL JOIN (SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
                     CAST(sum({LINE_PROFIT}) AS BIGINT) AS profit
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) d USING (month_start)""",
)
def a12_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored report from unit-level profit next to the profit of the lines themselves."""
    lines, days = views.order_lines(spark, sf_dir), views.orders_by_day(spark, sf_dir)
    path = scratch_path(spark, "report")
    report = patterns.profit_report(units(spark, sf_dir), days, "l_orderkey", "order_day")
    report.write.parquet(path)
    stored = spark.read.schema(report.schema).parquet(path)
    return patterns.reconcile(stored, lines, days, "l_orderkey", "order_day", line_profit())


@query(
    "a12_growth",
    using(
        """SELECT CAST(day AS VARCHAR) AS day, n_new, n_total,
            CASE WHEN n_total > n_new THEN round(CAST(n_new AS DOUBLE) / (n_total - n_new), 6) END AS growth_rate
        FROM (SELECT day, n_new, CAST(sum(n_new) OVER (ORDER BY day) AS BIGINT) AS n_total
              FROM (SELECT day, count(*) AS n_new FROM (SELECT user_id, min(day) AS day FROM purchases_by_user GROUP BY 1) GROUP BY 1))""",
        "purchases_by_user",
    ),
)
def a12_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = views.purchases_by_user(spark, sf_dir).groupBy("user_id").agg(F.min("day").alias("day"))
    return patterns.daily_growth(first, "day")


@query(
    "a12_engagement",
    using(
        """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
            round(CAST(count(*) AS DOUBLE) / count(DISTINCT user_id), 6) AS events_per_user
        FROM web_events WHERE user_id IS NOT NULL GROUP BY 1""",
        "web_events",
    ),
)
def a12_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.engagement_report(views.web_events(spark, sf_dir), "user_id", "event_time")
