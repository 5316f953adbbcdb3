"""Active dates and growth states kept up to date by a stream of events.

A micro-batch stores its distinct (user, day) pairs. Once event time has passed
the end of a day, the day's step runs on the stored states of the day before, the
same step that a daily batch job runs. Everything a batch writes goes to
partitions that follow from the batch alone, so a batch that is repeated after a
failure replaces its own output and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.growth import growth_step
from ledgerline.sources import schemas
from ledgerline.sources.files import path_exists

DAYS = "user_id bigint, day date, batch_id bigint"
MARKS = "first_day date, last_micros bigint, closed date, late_rows bigint, late_users bigint, batch_id bigint"
STATES = schemas.TABLES["users_growth_accounting"].columns


@dataclass(frozen=True)
class Mark:
    """What is known after a batch: the first day with a known user, the latest event time, the last closed day."""

    first_day: date | None = None
    last_micros: int | None = None
    closed: date | None = None


@dataclass(frozen=True)
class DailyStates:
    """The stored tables below ``root``: pairs by day and batch, a mark per batch, states by day.

    A day is closed ``delay`` after its end in event time. ``user`` and ``time`` are
    columns of the stream; rows without either count for nothing.
    """

    spark: SparkSession
    root: str
    user: str = "user_id"
    time: str = "event_time"
    delay: timedelta = timedelta(seconds=15)

    def states(self) -> DataFrame:
        """Every user's state on every closed day."""
        return self._read("states", STATES)

    def late(self) -> DataFrame:
        """``batch_id, late_rows, late_users``: what came after its day was closed and is in no state."""
        return self._read("marks", MARKS).select("batch_id", "late_rows", "late_users")

    def _read(self, name: str, schema: str, part: str = "") -> DataFrame:
        """A table or one partition of it, whose folder alone is then listed; empty before its first write."""
        base = f"{self.root}/{name}"
        none = self.spark.createDataFrame([], schema)
        if not path_exists(self.spark, f"{base}/{part}"):
            return none
        return self.spark.read.schema(none.schema).option("basePath", base).parquet(f"{base}/{part}").select(none.columns)

    def _replace(self, df: DataFrame, name: str, by: list[str]) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(f"{self.root}/{name}")

    def _mark(self, batch_id: int) -> Mark:
        row = self._read("marks", MARKS, f"batch_id={batch_id}").first()
        return Mark(row["first_day"], row["last_micros"], row["closed"]) if row else Mark()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Store a micro-batch and step every day that it closes; for ``foreachBatch``."""
        before = self._mark(batch_id - 1)
        closed = before.closed
        seen = batch.select(
            F.col(self.user).cast("long").alias("user_id"), F.col(self.time).cast("timestamp").alias("time")
        ).filter("time is not null")
        pairs = seen.groupBy("user_id", F.to_date("time").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("time"))
        pairs = pairs.persist()
        try:
            known = F.col("user_id").isNotNull()
            late = known & (F.col("day") <= F.lit(closed)) if closed else F.lit(False)
            last = F.greatest(F.lit(before.last_micros).cast("long"), F.max(F.unix_micros("time")))
            over = F.to_date(F.timestamp_micros(last - self.delay // timedelta(microseconds=1)))
            row = pairs.agg(
                F.min(F.when(known & ~late, F.col("day"))).alias("first"), last.alias("last"), F.date_sub(over, 1).alias("closed"),
                F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0)).alias("rows"),
                F.count_distinct(F.when(late, F.col("user_id"))).alias("users"),
            ).first()
            kept = pairs.filter(known & ~late).select("user_id", "day", F.lit(batch_id).cast("long").alias("batch_id"))
            self._replace(kept, "days", ["day", "batch_id"])
        finally:
            pairs.unpersist()
        first = min((d for d in (before.first_day, row["first"]) if d), default=None)
        now = Mark(first, row["last"], row["closed"])
        self._step(before, now, batch_id)
        # the mark comes last: a batch without one has not been taken in
        values = [(now.first_day, now.last_micros, now.closed, row["rows"], row["users"], batch_id)]
        self._replace(self.spark.createDataFrame(values, MARKS).coalesce(1), "marks", ["batch_id"])

    def _step(self, before: Mark, now: Mark, batch_id: int, until: date | None = None) -> None:
        """Run the steps of the days between what was closed and what is closed now."""
        until = until or now.closed
        if now.first_day is None or until is None:
            return
        was = before.closed
        # before the first closed day there is no state, and steps begin with the first day seen
        start = now.first_day if before.first_day is None or was is None else max(was + timedelta(days=1), now.first_day)
        for day in _range(start, until):
            events = self._read("days", DAYS, f"day={day}").filter(F.col("batch_id") <= batch_id)
            before_it = f"date={day - timedelta(days=1)}"
            if day > now.first_day and not path_exists(self.spark, f"{self.root}/states/{before_it}"):
                raise ValueError(f"needs the states of the day before {day}")
            prev = self._read("states", STATES, before_it)
            self._replace(growth_step(prev, events, "user_id", "day", day), "states", ["date"])

    def finish(self, until: date) -> None:
        """Close all days up to ``until``, e.g. when a source has ended; may be repeated."""
        last_batch = self.late().agg(F.max("batch_id")).first()[0]
        if last_batch is None:
            return
        mark = self._mark(last_batch)
        self._step(mark, mark, last_batch, until)

    def start(self, events: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Run the stream; ``every`` gives a running job, without it all data at hand is processed once."""
        writer = events.select(self.user, self.time).writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _range(first: date, last: date) -> Iterator[date]:
    while first <= last:
        yield first
        first += timedelta(days=1)
