"""Event-time windows; each works on a stream and on a finished table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WATERMARK = "15 seconds"
TUMBLE = "5 minutes"
SESSION_GAP = "5 minutes"


def tumbling_hits(
    events: DataFrame,
    time: str,
    keys: Sequence[str],
    counted: str = "host",
    width: str = TUMBLE,
    delay: str = WATERMARK,
) -> DataFrame:
    """Non-null ``counted`` values per window and key.

    In append mode a window comes out once the watermark has passed its end;
    counts are combined on the map side, so a hot key is one row per task.
    """
    hits = events.withWatermark(time, delay).groupBy(F.window(time, width), *keys)
    return hits.agg(F.count(counted).alias("num_hits")).select(
        F.col("window.start").alias("window_start"), *keys, "num_hits"
    )


def sessions(
    events: DataFrame, time: str, keys: Sequence[str], gap: str = SESSION_GAP, delay: str = WATERMARK
) -> DataFrame:
    """Sessions per key on a stream; events exactly one gap apart share a session."""
    grouped = events.withWatermark(time, delay).groupBy(F.session_window(time, gap), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("num_events")).select(
        *keys,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "num_events",
    )


def sessions_of_table(
    events: DataFrame, time: str, keys: Sequence[str], gap_seconds: int, slice_seconds: int = 3600
) -> DataFrame:
    """The same sessions over a finished table, for backfills.

    Events of a key in one second always share a session, so they become one
    row in each task before anything is shuffled. Sessions are then built inside
    slices of time, each of ``slice_seconds`` rows at most, and the pieces, one
    row each, are merged per key: what a task orders is bounded by the time
    covered, whatever a key's number of events.
    """
    if gap_seconds < 1:
        raise ValueError("the gap must be a second or more")
    gap = gap_seconds * 1_000_000
    stamped = events.filter(F.col(time).isNotNull()).select(
        *keys, F.unix_micros(F.col(time).cast("timestamp")).alias("_t")
    )
    seconds = stamped.groupBy(*keys, F.floor(F.col("_t") / 1_000_000).alias("_second")).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_events")
    )
    sliced = seconds.withColumn("_slice", F.floor(F.col("_second") / slice_seconds))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_second")
    breaks = F.when(F.col("_first") - F.lag("_last").over(inside) <= gap, 0).otherwise(1)
    pieces = (
        sliced.withColumn("_break", breaks)
        .withColumn("_piece", F.sum("_break").over(inside))
        .groupBy(*keys, "_slice", "_piece")
        .agg(F.min("_first").alias("_from"), F.max("_last").alias("_to"), F.sum("_events").alias("_n"))
    )
    per_key = Window.partitionBy(*keys).orderBy("_from")
    apart = F.when(F.col("_from") - F.lag("_to").over(per_key) <= gap, 0).otherwise(1)
    merged = (
        pieces.withColumn("_break", apart)
        .withColumn("_session", F.sum("_break").over(per_key))
        .groupBy(*keys, "_session")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("num_events"))
    )
    return merged.select(
        *keys,
        F.timestamp_micros("_from").alias("session_start"),
        F.timestamp_micros(F.col("_to") + gap).alias("session_end"),
        "num_events",
    )


def session_means(session_rows: DataFrame, host: str = "host") -> DataFrame:
    """Mean events per session for each host, and over all under ``(overall)``."""
    per_host = session_rows.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_sessions"), F.sum("num_events").alias("n_events")
    )
    levels = per_host.groupingSets([[F.col(host)], []], F.col(host)).agg(
        F.grouping(host).alias("_all"), F.sum("n_sessions").alias("n_sessions"), F.sum("n_events").alias("n_events")
    )
    return levels.select(
        F.when(F.col("_all") == 1, "(overall)").otherwise(F.col(host)).alias(host),
        "n_sessions",
        "n_events",
        F.try_divide(F.col("n_events").cast("double"), F.col("n_sessions").cast("double")).alias("avg_events"),
    )
