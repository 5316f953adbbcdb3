"""Growth states of a stream against the batch operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerline.operators import growth
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.streaming import daily

EVENT = "user_id long, event_time timestamp"


def at(day: int, hour: float = 12) -> datetime:
    return datetime(2024, 3, 1) + timedelta(days=day, hours=hour)


BATCHES = [
    [(1, at(0)), (2, at(0, 1)), (1, at(0, 13)), (None, at(0))],
    [(2, at(1)), (3, at(2)), (1, at(1, 23.999))],
    [],
    [(1, at(2, 23)), (4, at(5)), (None, None)],
    [(5, at(3)), (5, at(3, 1)), (6, at(1)), (4, at(5, 1))],  # two users come too late
    [(2, at(7, 1))],
]


def frames(spark, batches=BATCHES):
    return [spark.createDataFrame(b, EVENT) for b in batches]


def table(spark) -> daily.DailyStates:
    return daily.DailyStates(spark, scratch_path(spark, "daily"))


def in_time(spark):
    known = [r for b in BATCHES for r in b if r[0] not in (5, 6)]
    return spark.createDataFrame(known, EVENT)


@pytest.fixture(scope="module")
def once(spark):
    got = table(spark)
    for number, batch in enumerate(frames(spark)):
        got.take(batch, number)
    return got


def test_states_equal_the_backfill(spark, once):
    # day 7 has begun, so days up to 6 are closed
    want = growth.growth_backfill(in_time(spark), "user_id", "event_time", date(2024, 3, 7))
    assert rows(once.states(), *want.columns) == rows(want)


def test_late_rows_are_counted_and_change_nothing(once):
    assert rows(once.late().filter("late_rows > 0")) == [(4, 3, 2)]
    assert once.states().filter("user_id in (5, 6)").count() == 0


def test_the_end_of_a_source_closes_its_days(spark):
    got = table(spark)
    got.take(frames(spark)[0], 0)
    for _ in range(2):
        got.finish(date(2024, 3, 2))
        want = growth.growth_backfill(spark.createDataFrame(BATCHES[0], EVENT), "user_id", "event_time", date(2024, 3, 2))
        assert rows(got.states(), *want.columns) == rows(want)


def test_a_repeated_batch_changes_nothing(spark, once):
    again = table(spark)
    for number, batch in enumerate(frames(spark)):
        for _ in range(2):
            again.take(batch, number)
    for of in (daily.DailyStates.states, daily.DailyStates.late):
        assert rows(of(once)) == rows(of(again))


def test_a_batch_that_failed_half_way_is_repeated(spark, monkeypatch):
    got, calls = table(spark), []
    step = daily.growth_step

    def failing(*args):
        calls.append(args[-1])
        if len(calls) == 4:
            raise RuntimeError("executor lost")
        return step(*args)

    monkeypatch.setattr(daily, "growth_step", failing)
    failed = 0
    for number, batch in enumerate(frames(spark)):
        try:
            got.take(batch, number)
        except RuntimeError:
            failed += 1
            got.take(batch, number)
    assert failed == 1
    want = growth.growth_backfill(in_time(spark), "user_id", "event_time", date(2024, 3, 7))
    assert rows(got.states(), *want.columns) == rows(want)


def test_missing_states_are_an_error(spark):
    got = table(spark)
    batches = frames(spark)
    got.take(batches[0], 0)
    got.take(batches[1], 1)
    with pytest.raises(ValueError, match="needs the states"):
        got._step(daily.Mark(date(2024, 3, 1), 0, date(2024, 3, 5)), daily.Mark(date(2024, 3, 1), 0, date(2024, 3, 7)), 1)


def test_no_known_user_no_state(spark):
    got = table(spark)
    got.take(spark.createDataFrame([(None, at(0)), (None, at(5))], EVENT), 0)
    assert got.states().count() == 0 and rows(got.late()) == [(0, 0, 0)]
    got.finish(date(2024, 3, 9))
    assert got.states().count() == 0


def test_the_stream_goes_on_after_a_restart(spark):
    got, source, checkpoint = table(spark), scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-checkpoint")
    for batch in frames(spark):
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT).parquet(source)
        got.start(stream, checkpoint).awaitTermination()
    want = growth.growth_backfill(in_time(spark), "user_id", "event_time", date(2024, 3, 7))
    assert rows(got.states(), *want.columns) == rows(want)
    assert got.late().agg(F.sum("late_rows")).first()[0] == 3


def test_paths(spark, tmp_path):
    assert not files.path_exists(spark, str(tmp_path / "no"))
    assert files.path_exists(spark, str(tmp_path))
