"""Active dates, datelists, month arrays, growth and retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.catalog.views import stored
from ledgerline.operators import activity, arrays, growth
from ledgerline.session import scratch_path
from ledgerline.sources import upserts

AS_OF = date(2024, 1, 30)
BEFORE = AS_OF - timedelta(days=1)
DAY = "CAST(CAST(day AS DATE) AS VARCHAR)"
DAYS = f"string_agg({DAY}, ',' ORDER BY day)"
BITS = "CAST(sum(CAST(1 AS BIGINT) << CAST(31 - (DATE '2024-01-30' - day) AS INTEGER)) AS BIGINT)"


FIRST_DAYS = ("num_hits_first_day", "num_hits_second_day", "num_hits_third_day")


def text(array: str) -> Column:
    return F.array_join(F.col(array).cast("array<string>"), ",", "null")


@query(
    "f6_active_dates",
    using(
        f"SELECT user_id, count(*) AS n_dates, {DAYS} AS dates_active, '2024-01-30' AS date FROM active_days GROUP BY 1",
        "active_days",
    ),
)
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    days = [activity.active_dates_backfill(events, ["user_id"], "event_time", d) for d in (BEFORE - timedelta(days=1), BEFORE)]
    prev = stored(spark, days[0].unionByName(days[1]), "active-dates", "date")
    now = activity.active_dates_step(prev, events, ["user_id"], "event_time", AS_OF)
    return now.select("user_id", F.size("dates_active").alias("n_dates"), text("dates_active").alias("dates_active"), "date")


def user_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    return activity.datelist(activity.active_dates_backfill(events, ["user_id"], "event_time", AS_OF), AS_OF)


@query(
    "f7_datelist_int",
    using(f"SELECT user_id, {BITS} AS datelist_int, '2024-01-30' AS date FROM active_days GROUP BY 1", "active_days"),
)
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_bits(spark, sf_dir)


@query(
    "f8_activity_flags",
    using(
        f"""SELECT user_id, {BITS} AS datelist_int, '2024-01-30' AS date, count(*) > 0 AS monthly_active, count(*) AS l32,
        count(*) FILTER (day > DATE '2024-01-23') > 0 AS weekly_active,
        count(*) FILTER (day > DATE '2024-01-23') AS l7,
        count(*) FILTER (day BETWEEN DATE '2024-01-17' AND DATE '2024-01-23') > 0 AS weekly_active_previous_week,
        count(*) FILTER (day = DATE '2024-01-30') > 0 AS daily_active FROM active_days GROUP BY 1""",
        "active_days",
    ),
)
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.activity_flags(user_bits(spark, sf_dir))


BROWSER_DAYS = """(SELECT DISTINCT user_id, browser_type, CAST(event_time AS DATE) AS day FROM web_events
        JOIN devices USING (device_id) WHERE user_id IS NOT NULL)"""


def browser_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity.device_activity(
        views.web_events(spark, sf_dir), views.devices(spark, sf_dir), "user_id", "device_id", "browser_type", "event_time", AS_OF
    )
    return activity.as_label_map(rows, "user_id", "browser_type")


@query(
    "f9_device_activity",
    using(
        f"""SELECT user_id, browser_type, count(*) AS n_dates, {DAYS} AS dates_active, '2024-01-30' AS date
        FROM {BROWSER_DAYS} GROUP BY 1, 2""",
        "web_events",
        "devices",
    ),
)
def f9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = browser_map(spark, sf_dir).select(
        "user_id", F.explode("device_activity_datelist").alias("browser_type", "dates_active"), "date"
    )
    return rows.select(
        "user_id", "browser_type", F.size("dates_active").alias("n_dates"), text("dates_active").alias("dates_active"), "date"
    )


@query(
    "f10_device_datelist",
    using(
        f"SELECT user_id, browser_type, {BITS} AS datelist_int, '2024-01-30' AS date FROM {BROWSER_DAYS} GROUP BY 1, 2",
        "web_events",
        "devices",
    ),
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.datelist_of_map(browser_map(spark, sf_dir), "user_id", "browser_type", AS_OF)


@query(
    "f11_host_dates",
    using(
        f"""SELECT host, count(*) AS n_dates, {DAYS} AS dates_active, '2024-01-30' AS date
        FROM (SELECT DISTINCT host, CAST(event_time AS DATE) AS day FROM web_events) GROUP BY 1""",
        "web_events",
    ),
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    prev = activity.active_dates_backfill(events, ["host"], "event_time", BEFORE)
    now = activity.active_dates_step(prev, events, ["host"], "event_time", AS_OF)
    return now.select("host", F.size("dates_active").alias("n_dates"), text("dates_active").alias("dates_active"), "date")


CALENDAR = "(SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)"
USER_HITS = "(SELECT user_id, CAST(event_time AS DATE) AS day, count(*) AS n FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)"


@query(
    "f12_array_metric",
    using(
        f"""SELECT u.user_id, '2024-01-01' AS month_start, 'site_hits' AS metric_name,
        string_agg(CAST(coalesce(h.n, 0) AS VARCHAR), ',' ORDER BY c.day) AS metric_array
        FROM (SELECT DISTINCT user_id FROM {USER_HITS}) u CROSS JOIN {CALENDAR} c
        LEFT JOIN {USER_HITS} h ON h.user_id = u.user_id AND h.day = c.day GROUP BY 1""",
        "web_events",
    ),
)
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    prev = arrays.array_metric_backfill(events, "user_id", "event_time", "site_hits", BEFORE)
    now = arrays.array_metric_step(prev, events, "user_id", "event_time", "site_hits", AS_OF)
    return now.withColumn("metric_array", text("metric_array"))


METRIC = "user_id bigint, month_start date, metric_name string, metric_array array<bigint>"


@query(
    "f12_upsert",
    using(
        f""", all_hits AS (SELECT 'site_hits' AS metric_name, user_id, CAST(event_time AS DATE) AS day FROM web_events
            UNION ALL SELECT 'purchases', user_id, CAST(event_time AS DATE) FROM web_events WHERE url = '/purchase'),
        daily AS (SELECT metric_name, user_id, day, count(*) AS n FROM all_hits WHERE user_id IS NOT NULL GROUP BY ALL),
        kept AS (SELECT DISTINCT metric_name, user_id, CASE WHEN metric_name = 'site_hits' THEN DATE '2024-01-30' ELSE DATE '2024-01-29' END AS last
            FROM daily WHERE metric_name = 'site_hits' OR day <= DATE '2024-01-29')
        SELECT k.user_id, '2024-01-01' AS month_start, k.metric_name,
        string_agg(CAST(coalesce(d.n, 0) AS VARCHAR), ',' ORDER BY c.day) AS metric_array
        FROM kept k JOIN {CALENDAR} c ON c.day <= k.last
        LEFT JOIN daily d ON d.metric_name = k.metric_name AND d.user_id = k.user_id AND d.day = c.day GROUP BY k.user_id, k.metric_name""",
        "web_events",
    ),
)
def f12_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of one metric upserted into a stored table of two metrics, and once more as after a failure."""
    events, path = views.web_events(spark, sf_dir), scratch_path(spark, "metrics")
    keys, by = ["user_id", "month_start", "metric_name"], ["month_start", "metric_name"]
    buying = arrays.array_metric_backfill(views.purchases(spark, sf_dir), "user_id", "event_time", "purchases", BEFORE)
    visits = arrays.array_metric_backfill(events, "user_id", "event_time", "site_hits", BEFORE)
    table = upserts.upsert_table(spark, path, METRIC, visits.unionByName(buying), keys, by)
    day = stored(spark, arrays.array_metric_step(table, events, "user_id", "event_time", "site_hits", AS_OF), "day", "month_start")
    for _ in range(2):
        table = upserts.upsert_table(spark, path, METRIC, day, keys, by)
    return table.withColumn("metric_array", text("metric_array"))


def site_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays.array_metric_backfill(views.web_events(spark, sf_dir), "user_id", "event_time", "site_hits", AS_OF)


@query(
    "f13_array_cardinality",
    using(
        f"""SELECT n_slots, count(*) AS n_rows FROM (SELECT u.user_id, count(c.day) AS n_slots
        FROM (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL) u CROSS JOIN {CALENDAR} c GROUP BY 1) GROUP BY 1""",
        "web_events",
    ),
)
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays.array_lengths(site_hits(spark, sf_dir), "metric_array")


@query(
    "f14_array_to_daily",
    using(
        """SELECT 'site_hits' AS metric_name, CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, count(*) AS value
        FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2""",
        "web_events",
    ),
)
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays.arrays_to_daily(site_hits(spark, sf_dir), ["metric_name"], "metric_array", "value")


MONTHLY_HITS = f"""SELECT u.user_id, string_agg(coalesce(CAST(h.n AS VARCHAR), 'null'), ',' ORDER BY c.day) AS hit_array,
        '2024-01-01' AS month_start, CAST(min(h.day) AS VARCHAR) AS first_found_date, '2024-01-30' AS date_partition
        FROM (SELECT DISTINCT user_id FROM {USER_HITS}) u CROSS JOIN {CALENDAR} c
        LEFT JOIN {USER_HITS} h ON h.user_id = u.user_id AND h.day = c.day GROUP BY 1"""


@query("f15_monthly_hits", using(MONTHLY_HITS, "web_events"))
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    earlier = [arrays.monthly_hits_backfill(events, "user_id", "event_time", d) for d in (BEFORE - timedelta(days=1), BEFORE)]
    prev = stored(spark, earlier[0].unionByName(earlier[1]), "hits", "date_partition")
    now = arrays.monthly_hits_step(prev, events, "user_id", "event_time", AS_OF)
    return now.withColumn("hit_array", text("hit_array"))


@query(
    "f15_month_change",
    using(
        """SELECT user_id, CAST(count(*) AS VARCHAR) AS hit_array, '2024-02-01' AS month_start, '2024-02-01' AS first_found_date,
        '2024-02-01' AS date_partition FROM web_events
        WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) = DATE '2024-01-30' GROUP BY 1""",
        "web_events",
    ),
)
def f15_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step into a new month, over all events moved ahead by two days."""
    moved = views.web_events(spark, sf_dir).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 2 DAYS"))
    before = arrays.monthly_hits_backfill(moved, "user_id", "event_time", date(2024, 1, 31))
    prev = stored(spark, before, "hits", "date_partition")
    now = arrays.monthly_hits_step(prev, moved, "user_id", "event_time", date(2024, 2, 1))
    return now.withColumn("hit_array", text("hit_array"))


@query(
    "f16_first_days",
    using(
        """SELECT '2024-01-01' AS month_start,
        count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-01') AS num_hits_first_day,
        count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-02') AS num_hits_second_day,
        count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-03') AS num_hits_third_day
        FROM web_events WHERE user_id IS NOT NULL""",
        "web_events",
    ),
)
def f16(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = arrays.monthly_hits_backfill(views.web_events(spark, sf_dir), "user_id", "event_time", AS_OF)
    return arrays.first_days(hits, "hit_array", "date_partition", AS_OF, FIRST_DAYS)


@query(
    "f16_first_days_null",
    using(
        """SELECT '2024-01-01' AS month_start,
        nullif(count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-01'), 0) AS num_hits_first_day,
        nullif(count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-02'), 0) AS num_hits_second_day,
        nullif(count(*) FILTER (CAST(event_time AS DATE) = DATE '2024-01-03'), 0) AS num_hits_third_day
        FROM web_events WHERE user_id IS NOT NULL""",
        "web_events",
    ),
)
def f16_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with days without any hit left null."""
    hits = arrays.monthly_hits_backfill(views.web_events(spark, sf_dir), "user_id", "event_time", AS_OF)
    return arrays.first_days(hits, "hit_array", "date_partition", AS_OF, FIRST_DAYS, keep_null=True)


@query(
    "f17_host_reduced",
    using(
        """SELECT host, '2024-01-01' AS month_start, string_agg(CAST(n AS VARCHAR), ',' ORDER BY day) AS hit_array,
        string_agg(CAST(u AS VARCHAR), ',' ORDER BY day) AS unique_visitors
        FROM (SELECT host, CAST(event_time AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS u
              FROM web_events GROUP BY 1, 2) GROUP BY 1""",
        "web_events",
    ),
)
def f17(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.web_events(spark, sf_dir)
    prev = arrays.host_month(events, "host", "user_id", "event_time", BEFORE)
    now = arrays.host_month_step(prev, events, "host", "user_id", "event_time", AS_OF)
    return now.withColumns({"hit_array": text("hit_array"), "unique_visitors": text("unique_visitors")})


def growth_sql(body: str, name: str = "growth") -> str:
    return using(f"SELECT {body} FROM {name}", name)


STATES = """user_id, CAST(first_day AS VARCHAR) AS first_active_date, CAST(last_active_date AS VARCHAR) AS last_active_date,
        daily_active_state, weekly_active_state, n_dates, CAST(date AS VARCHAR) AS date"""


def sized(df: DataFrame) -> DataFrame:
    return df.withColumn("n_dates", F.size("dates_active")).drop("dates_active")


@query("a1_growth_accounting", growth_sql(STATES))
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a known user counts as being active."""
    return sized(growth.growth_backfill(views.web_events(spark, sf_dir), "user_id", "event_time", AS_OF))


@query("a1_growth_purchases", growth_sql(STATES, "buying_growth"))
def a1_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for one kind of event."""
    return sized(growth.growth_backfill(views.purchases(spark, sf_dir), "user_id", "event_time", AS_OF))


@query("a1_growth_step", growth_sql(STATES) + " WHERE date = DATE '2024-01-30'")
def a1_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day on top of yesterday's partition of a stored table."""
    events = views.web_events(spark, sf_dir)
    recent = growth.growth_backfill(events, "user_id", "event_time", BEFORE).filter(F.col("date") >= F.lit(BEFORE - timedelta(days=1)))
    prev = stored(spark, recent, "growth", "date")
    return sized(growth.growth_step(prev, events, "user_id", "event_time", AS_OF))


@query(
    "a2_retention",
    growth_sql(
        """CAST(date - first_day AS BIGINT) AS days_since_first_active,
        round(CAST(count(*) FILTER (is_on) AS DOUBLE) / count(*), 6) AS pct_active, count(*) AS n"""
    )
    + " GROUP BY 1",
)
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = growth.growth_backfill(views.web_events(spark, sf_dir), "user_id", "event_time", AS_OF, with_dates=False)
    return growth.retention(rows)
