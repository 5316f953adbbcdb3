"""Windows and sessions whose open state outlives a stop of the job."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import scratch_path
from ledgerline.streaming import sinks

# Fixed value: Spark's own state store that keeps state on disk and checkpoints it.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, provider: str = ROCKSDB) -> SparkSession:
    """A session for stateful streams: its own state store provider, the caller's settings as they were."""
    other = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        other.conf.set(name, spark.conf.get(name))
    other.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    other.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    other.conf.set(sinks.MERGE_LOCALLY, "true")
    return other


def open_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key`` and ``value`` structs that a stopped query holds in its state."""
    return spark.read.format("statestore").load(checkpoint).select("key", "value")


def run_in_stretches(
    spark: SparkSession,
    arrivals: Iterable[DataFrame],
    source: Callable[[str], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    label: str,
    seen: Callable[[DataFrame, DataFrame], None] | None = None,
) -> DataFrame:
    """Start and stop a stateful query once per arrival; return all rows it has put out.

    Each arrival is added to a folder that ``source`` streams; ``build`` makes the
    query, which goes on from its checkpoint: windows that were open at the stop
    are recovered from the state store. ``seen`` is shown the output so far and the
    open state after each stop.
    """
    path, out, checkpoint = (scratch_path(spark, f"{label}-{x}") for x in ("arrivals", "rows", "checkpoint"))
    rows = None
    for arrival in arrivals:
        arrival.write.mode("append").parquet(path)
        stream = build(source(path))
        sinks.start_append(stream, out, checkpoint).awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(out)
        if seen is not None:
            seen(rows, open_state(spark, checkpoint))
    return rows
