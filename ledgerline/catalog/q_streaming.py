"""Streams run to their end over all rows at hand, and their table counterparts.

Windowed queries read the events as a topic would bring them: several batches
in the order of time, one row that comes much too late, and at last a row far
ahead in time, which closes every window and session before it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.session import scratch_path
from ledgerline.sources import geo, layout
from ledgerline.streaming import daily, late, recovery, sinks, windows
from ledgerline.streaming import events as source

SLICES, LEAST_FILES, FILE_BYTES = 4, 2, 64 << 20
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of web hits."""
    return views.web_events_of(source.read_table_stream(spark, f"{sf_dir}/events.parquet"))


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in slices of time, and at last a late row and one that closes all windows."""
    rows = views.table(spark, sf_dir, "events")
    span = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (span["hi"] - span["lo"]) / SLICES
    slices = []
    for i in range(SLICES):
        cut = F.col("ts") >= F.lit(span["lo"] + i * step)
        if i < SLICES - 1:
            cut = cut & (F.col("ts") < F.lit(span["lo"] + (i + 1) * step))
        slices.append(rows.filter(cut))
    early, closing = span["lo"] - timedelta(days=1), span["hi"] + timedelta(days=1)
    marker = {"event_id": F.lit(-1), "ts": F.explode(F.array(F.lit(early), F.lit(closing))), "props": F.lit('{"k": 0}')}
    fields = [marker.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != "ts"]
    last = spark.range(1).select(marker["ts"].alias("ts"), *fields).withColumn("ts", F.col("ts").cast(rows.schema["ts"].dataType))
    return [*slices, last.select(rows.columns)]


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in batches of time, with a late row and a closing one, as a stream of web hits."""
    path = scratch_path(spark, "events")
    *slices, last = arrivals(spark, sf_dir)
    # a batch is a slice: each has the same number of files, which follows the size of the table
    size = layout.stored_bytes(spark, f"{sf_dir}/events.parquet")
    files = max(LEAST_FILES, -(-size // (SLICES * FILE_BYTES)))
    for rows in slices:
        rows.repartition(files).write.mode("append").parquet(path)
    last.write.mode("append").parquet(path)
    return views.web_events_of(source.read_table_stream(spark, path, files))


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """All web events as JSON lines, as a topic would carry them."""
    rows = views.web_events(spark, sf_dir).select(
        "url",
        "referrer",
        F.lit("agent").alias("user_agent"),
        "host",
        "ip",
        F.lit(None).cast("string").alias("headers"),
        F.date_format("event_time", source.EVENT_TIME_FORMAT).alias("event_time"),
    )
    path = scratch_path(spark, "messages")
    source.to_messages(rows).write.text(path)
    return path


def place_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.geo_ranges(spark, sf_dir)


@query(
    "t1_json_source",
    using(
        f"""SELECT ip, {STAMP.format("date_trunc('milliseconds', event_time)")} AS event_timestamp, referrer, host, url
        FROM web_events""",
        "web_events",
    ),
)
def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = source.read_messages(spark, "text", path=message_files(spark, sf_dir))
    parsed = source.good_events(source.parse_messages(messages))
    rows = parsed.select("ip", "event_timestamp", "referrer", "host", "url")
    return sinks.run_to_end(spark, {"t1": rows})["t1"]


@query(
    "t6_message_sink",
    using("SELECT ip, host, url, referrer, count(*) AS n FROM web_events GROUP BY ALL", "web_events"),
)
def t6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events sent on as JSON messages by a stream, and read back."""
    rows = event_stream(spark, sf_dir).select("ip", "host", "url", "referrer")
    path, checkpoint = scratch_path(spark, "sent"), scratch_path(spark, "sent-checkpoint")
    sinks.start_messages(rows, "text", {"path": path}, checkpoint).awaitTermination()
    back = spark.read.text(path).select(F.from_json("value", "ip string, host string, url string, referrer string").alias("m"))
    return back.select("m.*").groupBy("ip", "host", "url", "referrer").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t5_batch_folders",
    using(
        f"""SELECT ip, {STAMP.format("event_time")} AS event_timestamp, referrer, host, url, count(*) AS n
        FROM web_events GROUP BY ALL""",
        "web_events",
    ),
)
def t5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended batch by batch, each batch to a folder of its own that a rerun replaces, and read back."""
    rows = replayed(spark, sf_dir).filter("event_id >= 0").select("ip", F.col("event_time").alias("event_timestamp"), "referrer", "host", "url")
    path, checkpoint = scratch_path(spark, "batches"), scratch_path(spark, "batches-checkpoint")
    sinks.start_batches(rows, path, checkpoint).awaitTermination()
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    back = sinks.batch_rows(spark, path, rows.columns, schema)
    return back.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "t11_restart",
    using(f"SELECT event_id, count(*) AS n, min({STAMP.format('event_time')}) AS event_time FROM web_events GROUP BY 1", "web_events"),
)
def t11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped after half of the files and started again from its checkpoint: no row is lost or repeated."""
    path, out, checkpoint = (scratch_path(spark, x) for x in ("halves", "halves-rows", "halves-checkpoint"))
    rows = views.table(spark, sf_dir, "events")
    for half in (0, 1):
        rows.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(path)
        stream = views.web_events_of(source.read_table_stream(spark, path)).select("event_id", "event_time")
        sinks.start_append(stream, out, checkpoint).awaitTermination()
    back = spark.read.schema("event_id long, event_time timestamp").parquet(out)
    return back.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_time").alias("event_time"))


def restarted(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``build`` over the events, stopped and started again after each slice of time, its windows left open in between."""
    other = recovery.stream_session(spark)
    hits = lambda path: views.web_events_of(source.read_table_stream(other, path))
    return recovery.run_in_stretches(other, arrivals(other, sf_dir), hits, build, label)


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events by slices of time, but a part of the first slice comes last, as a stream of web hits."""
    path = scratch_path(spark, "late-events")
    first, *others = arrivals(spark, sf_dir)[:-1]
    delayed = F.col("event_id") % 9 == 0
    for rows in (first.filter(~delayed), *others, first.filter(delayed)):
        rows.coalesce(1).write.mode("append").parquet(path)
    return views.web_events_of(source.read_table_stream(spark, path, 1))


@query(
    "t2_late_rows",
    using(
        """SELECT host, count(*) FILTER (NOT late) AS n_kept, count(*) FILTER (late) AS n_late, count(*) AS n_rows
        FROM (SELECT host, event_id % 9 = 0 AND event_time < (SELECT min(ts) + (max(ts) - min(ts)) / 4 FROM events) AS late FROM web_events)
        GROUP BY 1""",
        "web_events",
    ),
)
def t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of five-minute windows takes in and what comes too late for it, per host."""
    stream = late_arrivals(spark, sf_dir)
    schema = ", ".join(f"{n} {t}" for n, t in stream.dtypes)
    split = late.LateSplit(spark, scratch_path(spark, "late"), schema)
    split.start(stream, scratch_path(spark, "late-checkpoint")).awaitTermination()
    return split.rows().groupBy("host").agg(
        F.count_if(~F.col("late")).alias("n_kept"), F.count_if("late").alias("n_late"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "t13_daily_growth",
    using(
        """SELECT user_id, CAST(first_day AS VARCHAR) AS first_active_date, CAST(last_active_date AS VARCHAR) AS last_active_date,
        daily_active_state, weekly_active_state, n_dates, CAST(date AS VARCHAR) AS date FROM growth""",
        "growth",
    ),
)
def t13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth states kept by a stream of all events, day by day as event time passes them."""
    table = daily.DailyStates(spark, scratch_path(spark, "daily"))
    table.start(replayed(spark, sf_dir), scratch_path(spark, "daily-checkpoint")).awaitTermination()
    last = views.table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]
    if last is not None:
        table.finish(last)
    return table.states().withColumn("n_dates", F.size("dates_active")).drop("dates_active")


GEO_JOIN = """LEFT JOIN geo_ranges g ON CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
        + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) BETWEEN ip_from AND ip_to"""
GEO_TEXT = """CASE WHEN ip_from IS NULL THEN '{}' ELSE '{"country":"' || country || '","state":"' || state
        || '","city":"' || city || '"}' END"""


@query(
    "t3_geo_enrich",
    using(
        f"""SELECT ip, {STAMP.format("event_time")} AS event_timestamp, referrer, host, url, {GEO_TEXT} AS geodata
        FROM web_events {GEO_JOIN}""",
        "web_events",
        "geo_ranges",
    ),
)
def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_stream(spark, sf_dir).select(
        "ip", F.col("event_time").alias("event_timestamp"), "referrer", "host", "url"
    )
    located = geo.locate(rows, place_ranges(spark, sf_dir))
    return sinks.run_to_end(spark, {"t3": located})["t3"]


@query(
    "t4_geo_lookup",
    using(
        f"SELECT ip, {GEO_TEXT} AS geodata, count(*) AS n_hits FROM web_events {GEO_JOIN} GROUP BY 1, 2",
        "web_events",
        "geo_ranges",
    ),
)
def t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per address are added up first, so every address is looked up once."""
    per_ip = views.web_events(spark, sf_dir).groupBy("ip").agg(F.count(F.lit(1)).alias("n_hits"))
    return geo.locate(per_ip, place_ranges(spark, sf_dir))


def tumbling_sql(keys: str) -> str:
    return using(
        f"""SELECT {STAMP.format("w")} AS window_start, {keys}, count(host) AS num_hits
        FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '1970-01-01') AS w FROM web_events)
        GROUP BY w, {keys}""",
        "web_events",
    )


def both_tumbling(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two aggregations of one source, as two queries side by side."""
    stream = replayed(spark, sf_dir)
    return sinks.run_to_end(
        spark,
        {
            "by_host": windows.tumbling_hits(stream, "event_time", ["host"]),
            "by_referrer": windows.tumbling_hits(stream, "event_time", ["host", "referrer"]),
        },
    )


@query("t7_tumbling_host", tumbling_sql("host"))
def t7(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows.tumbling_hits(replayed(spark, sf_dir), "event_time", ["host"])
    return sinks.run_to_end(spark, {"t7": stream})["t7"]


@query("t8_tumbling_referrer", tumbling_sql("host, referrer"))
def t8(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows.tumbling_hits(replayed(spark, sf_dir), "event_time", ["host", "referrer"])
    return sinks.run_to_end(spark, {"t8": stream})["t8"]


@query("t11_windows_recovered", tumbling_sql("host"))
def t11_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restarted(spark, sf_dir, lambda hits: windows.tumbling_hits(hits, "event_time", ["host"]), "t11w")


@query(
    "t12_two_outputs",
    using(
        f"""SELECT 'by_host' AS output, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS num_hits
        FROM (SELECT w, host, count(host) AS n FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '1970-01-01') AS w
              FROM web_events) GROUP BY 1, 2)
        UNION ALL
        SELECT 'by_referrer', count(*), CAST(sum(n) AS BIGINT)
        FROM (SELECT w, host, referrer, count(host) AS n FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '1970-01-01') AS w
              FROM web_events) GROUP BY 1, 2, 3)""",
        "web_events",
    ),
)
def t12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, rows in both_tumbling(spark, sf_dir).items():
        one = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("num_hits").alias("num_hits")).select(
            F.lit(name).alias("output"), "*"
        )
        out = one if out is None else out.unionByName(one)
    return out


GAP_SECONDS = 2 * 3600


def sessions_sql(gap: int) -> str:
    return f"""(SELECT ip, host, min(event_time) AS s, max(event_time) + INTERVAL {gap} SECOND AS e, count(*) AS n
        FROM (SELECT *, sum(brk) OVER (PARTITION BY ip, host ORDER BY event_time) AS grp
              FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY ip, host ORDER BY event_time)
                                     <= INTERVAL {gap} SECOND THEN 0 ELSE 1 END AS brk FROM web_events))
        GROUP BY ip, host, grp)"""


SESSIONS = sessions_sql(GAP_SECONDS)


@query(
    "t9_sessions_5min",
    using(
        f"""SELECT ip, host, {STAMP.format("s")} AS session_start, {STAMP.format("e")} AS session_end, n AS num_events
        FROM {sessions_sql(300)}""",
        "web_events",
    ),
)
def t9_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows.sessions(replayed(spark, sf_dir), "event_time", ["ip", "host"])
    return sinks.run_to_end(spark, {"t9s": stream})["t9s"]


@query(
    "t9_sessions",
    using(
        f"""SELECT ip, host, {STAMP.format("s")} AS session_start, {STAMP.format("e")} AS session_end, n AS num_events
        FROM {SESSIONS}""",
        "web_events",
    ),
)
def t9(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows.sessions(replayed(spark, sf_dir), "event_time", ["ip", "host"], f"{GAP_SECONDS} seconds")
    return sinks.run_to_end(spark, {"t9": stream})["t9"]


@query(
    "t11_sessions_recovered",
    using(
        f"""SELECT ip, host, {STAMP.format("s")} AS session_start, {STAMP.format("e")} AS session_end, n AS num_events
        FROM {SESSIONS}""",
        "web_events",
    ),
)
def t11_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that reach over a stop of the job go on after it."""
    gap = f"{GAP_SECONDS} seconds"
    return restarted(spark, sf_dir, lambda hits: windows.sessions(hits, "event_time", ["ip", "host"], gap), "t11s")


@query(
    "t9_sessions_table",
    using(
        f"SELECT ip, host, {STAMP.format('s')} AS session_start, {STAMP.format('e')} AS session_end, n AS num_events FROM {SESSIONS}",
        "web_events",
    ),
)
def t9_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions_of_table(views.web_events(spark, sf_dir), "event_time", ["ip", "host"], GAP_SECONDS)


@query(
    "t10_session_avg",
    using(
        f"""SELECT coalesce(host, '(overall)') AS host, count(*) AS n_sessions, CAST(sum(n) AS BIGINT) AS n_events,
        round(CAST(sum(n) AS DOUBLE) / count(*), 6) AS avg_events FROM {SESSIONS} GROUP BY GROUPING SETS ((host), ())""",
        "web_events",
    ),
)
def t10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.sessions_of_table(views.web_events(spark, sf_dir), "event_time", ["ip", "host"], GAP_SECONDS)
    return windows.session_means(rows)
