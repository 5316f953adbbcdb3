"""Starting streams and where their rows go."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.session import scratch_path
from ledgerline.streaming.events import to_messages

CHECKPOINT_EVERY = "10 seconds"
MERGE_LOCALLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append files; the sink's own log makes a rerun of a batch harmless.

    ``every`` gives a running job that commits at that interval, e.g.
    ``CHECKPOINT_EVERY``; without it all data at hand is processed once.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer.option("path", path), every).start()


def start_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch to its own ``batch_id`` folder, replacing it on a rerun."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def start_messages(
    df: DataFrame, fmt: str, options: dict[str, str], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Rows as JSON messages to a topic (``kafka``) or to lines of text files (``text``)."""
    writer = to_messages(df).writeStream.format(fmt).options(**options)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


@contextmanager
def sessions_merged_locally(spark: SparkSession) -> Iterator[None]:
    """Queries started inside merge the sessions of each task before the shuffle.

    A hot session key then moves as few rows as it has sessions.
    """
    before = spark.conf.get(MERGE_LOCALLY)
    spark.conf.set(MERGE_LOCALLY, "true")
    try:
        yield
    finally:
        spark.conf.set(MERGE_LOCALLY, before)


def run_to_end(spark: SparkSession, streams: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Process all data at hand, one query per name, and read the results back.

    Every query has its own checkpoint and output below the scratch root; they
    run side by side over their shared source.
    """
    started: list[tuple[str, str, StreamingQuery]] = []
    with sessions_merged_locally(spark):
        for name, df in streams.items():
            out = scratch_path(spark, f"{name}-rows")
            started.append((name, out, start_append(df, out, scratch_path(spark, f"{name}-checkpoint"))))
    for _, _, query in started:
        query.awaitTermination()
    return {name: spark.read.schema(streams[name].schema).parquet(out) for name, out, _ in started}


def batch_rows(spark: SparkSession, path: str, columns: Sequence[str], schema: str) -> DataFrame:
    """What ``start_batches`` wrote, without the batch folder column."""
    return spark.read.schema(f"{schema}, batch_id long").parquet(path).select(*columns)
