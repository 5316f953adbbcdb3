"""Web events joined to devices, and roll-ups by user and device.

The stored form of a roll-up is relational, one row per key and item; counts
and sums are aggregates of it with one row per key, whatever its size.
``grouping.lists_by_range`` turns items into lists of a fixed width on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_device_hosts(events: DataFrame, *extra: str) -> DataFrame:
    """Hits of each (user, device, host); ``extra`` columns join the key."""
    known = events.filter(F.col("user_id").isNotNull())
    return known.groupBy(*extra, "user_id", "device_id", "host").agg(F.count(F.lit(1)).alias("hits"))


def user_device_counts(events: DataFrame) -> DataFrame:
    """Hits of each (user, device); the roll-ups start from this."""
    known = events.filter(F.col("user_id").isNotNull())
    return known.groupBy("user_id", "device_id").agg(F.count(F.lit(1)).alias("event_counts"))


def user_device_hits(hosts: DataFrame, *extra: str) -> DataFrame:
    """Hits and hosts of each (user, device), from ``user_device_hosts``.

    ``host_array`` has the distinct hosts of one pair: at most the sites there are.
    """
    return hosts.groupBy(*extra, "user_id", "device_id").agg(
        F.sum("hits").alias("event_counts"),
        F.count(F.lit(1)).alias("n_hosts"),
        F.sort_array(F.collect_list("host")).alias("host_array"),
    )


def user_rollup(hits: DataFrame) -> DataFrame:
    """Largest hit count, number of devices and sum of their ids of each user."""
    return hits.groupBy("user_id").agg(
        F.max("event_counts").alias("total_hits"),
        F.count(F.lit(1)).alias("n_devices"),
        F.sum("device_id").alias("device_sum"),
    )


def device_rollup(hits: DataFrame, devices: DataFrame) -> DataFrame:
    """Number of users seen on each device and the sum of their ids."""
    users = hits.groupBy("device_id").agg(F.count(F.lit(1)).alias("n_users"), F.sum("user_id").alias("user_sum"))
    return users.join(devices.select("device_id", "device_type"), "device_id")


def enrich_typed(events: DataFrame, devices: DataFrame, no_referrer: str = "unknown") -> DataFrame:
    """Events with both ids, joined to their device; referrer defaulted, browser in capitals."""
    kept = events.filter(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    joined = kept.join(devices.select("device_id", "browser_type", "os_type", "device_type"), "device_id")
    return joined.withColumns(
        {
            "referrer": F.coalesce("referrer", F.lit(no_referrer)),
            "browser_type": F.upper("browser_type"),
        }
    )


def enrich_plain(events: DataFrame, devices: DataFrame) -> DataFrame:
    """The same join with the columns as they are."""
    kept = events.filter(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    return kept.join(devices.select("device_id", "browser_type", "os_type", "device_type"), "device_id")


def enrich_left(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Every event with its device if known, renamed families and the event's day."""
    return (
        events.withColumn("event_date", F.date_trunc("day", "event_time").cast("date"))
        .join(devices, "device_id", "left")
        .withColumnsRenamed(
            {"browser_type": "browser_family", "os_type": "os_family", "device_type": "device_family"}
        )
    )
