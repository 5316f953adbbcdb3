"""Rows that come after their window has closed: kept aside and counted.

A windowed aggregation drops late rows without a trace. Here each micro-batch is
split before the window by the same rule: the watermark of a batch is the latest
event time of the batches before it, less the delay, and a row is late if its
window has ended by then. Both parts are stored per batch, so a repeated batch
replaces its own rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources.files import path_exists

_MICRO = timedelta(microseconds=1)


@dataclass(frozen=True)
class LateSplit:
    """Stored rows below ``root``: ``rows`` by batch and ``late``, and the latest event time by batch.

    ``time`` is a timestamp column of the stream; rows without it go to neither part
    of a window and count as late.
    """

    spark: SparkSession
    root: str
    schema: str
    time: str = "event_time"
    width: timedelta = timedelta(minutes=5)
    delay: timedelta = timedelta(seconds=15)

    def _last_micros(self, batch_id: int) -> int | None:
        path = f"{self.root}/marks/batch_id={batch_id}"
        found = self.spark.read.schema("last_micros long").parquet(path).first() if path_exists(self.spark, path) else None
        return found and found["last_micros"]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Split and store a micro-batch; for ``foreachBatch``."""
        before = self._last_micros(batch_id - 1)
        at, wide = F.unix_micros(self.time), self.width // _MICRO
        closes = at - F.pmod(at, F.lit(wide)) + wide  # the window function would drop rows without a time
        late = F.col(self.time).isNull()
        if before is not None:
            late = late | (closes <= F.lit(before - self.delay // _MICRO))
        rows = batch.withColumns({"batch_id": F.lit(batch_id).cast("long"), "late": F.coalesce(late, F.lit(True))})
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id", "late").parquet(f"{self.root}/rows")
        last = F.greatest(F.lit(before).cast("long"), F.max(F.unix_micros(self.time)))
        mark = batch.agg(last.alias("last_micros"))
        mark.write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")

    def rows(self) -> DataFrame:
        """All rows with ``batch_id`` and ``late``."""
        schema = f"{self.schema}, batch_id long, late boolean"
        path = f"{self.root}/rows"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def start(self, events: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Run the stream; ``every`` gives a running job, without it all data at hand is processed once."""
        writer = events.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
