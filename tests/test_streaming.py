from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from helpers import as_set, rows
from ledgerline.session import scratch_path
from ledgerline.streaming import events as source
from ledgerline.streaming import late, recovery, sinks, windows

BASE = datetime(2024, 1, 1)
T = "event_timestamp"


def message(minute: float, host: str = "a", ip: str = "1.1.1.1", **extra) -> dict:
    moment = BASE + timedelta(minutes=minute)
    text = moment.strftime("%Y-%m-%dT%H:%M:%S.") + f"{moment.microsecond // 1000:03d}Z"
    return {"url": "/", "referrer": None, "host": host, "ip": ip, "event_time": text, **extra}


def put(folder: str, number: int, *messages) -> None:
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:04d}.txt"
    with open(path, "w") as out:
        for m in messages:
            out.write((m if isinstance(m, str) else json.dumps(m)) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, folder):
    raw = source.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, folder)
    return source.parse_messages(raw)


def run(query):
    query.awaitTermination()
    return query


def test_bad_messages_go_to_the_side(spark):
    folder = scratch_path(spark, "bad")
    put(folder, 1, message(1), "not json", {"host": "x", "event_time": "yesterday"})
    parsed = stream(spark, folder)
    out = sinks.run_to_end(
        spark, {"good": source.good_events(parsed).select("host", T), "bad": source.bad_messages(parsed)}
    )
    assert rows(out["good"]) == [("a", BASE + timedelta(minutes=1))]
    assert out["bad"].count() == 2


def test_tumbling_equals_batch_up_to_the_watermark_and_drops_late_rows(spark):
    folder = scratch_path(spark, "tumble")
    put(folder, 1, message(1), message(2), message(4.9, "b"))
    put(folder, 2, message(5), message(20))
    put(folder, 3, message(21))
    put(folder, 4, message(3), message(22))  # the first is late: its window is closed
    put(folder, 5, message(10_000))
    good = source.good_events(stream(spark, folder))
    out = sinks.run_to_end(spark, {"w": windows.tumbling_hits(good, T, ["host"])})["w"]

    def at(m):
        return BASE + timedelta(minutes=m)

    assert rows(out) == as_set([(at(0), "a", 2), (at(0), "b", 1), (at(5), "a", 1), (at(20), "a", 3)])


def test_null_host_counts_zero(spark):
    folder = scratch_path(spark, "nullhost")
    put(folder, 1, message(1, None), message(1, None))
    put(folder, 2, message(500))
    good = source.good_events(stream(spark, folder))
    out = sinks.run_to_end(spark, {"w": windows.tumbling_hits(good, T, ["host"])})["w"]
    assert rows(out, "host", "num_hits") == [(None, 0)]


def test_sessions_merge_at_exactly_the_gap(spark):
    folder = scratch_path(spark, "sessions")
    put(folder, 1, message(0), message(5), message(10.1, ip="2.2.2.2"), message(10.1))
    put(folder, 2, message(1000, "z"))
    put(folder, 3, message(2000, "z"))
    good = source.good_events(stream(spark, folder))
    out = sinks.run_to_end(spark, {"s": windows.sessions(good, T, ["ip", "host"])})["s"]
    got = rows(out.filter("host = 'a'"), "ip", "num_events")
    assert got == [("1.1.1.1", 1), ("1.1.1.1", 2), ("2.2.2.2", 1)]


def test_table_sessions_equal_stream_sessions(spark):
    minutes = [0, 3, 8, 9, 14.5, 30, 35, 59, 61, 64, 130, 180]
    messages = [message(m, h) for m in minutes for h in ("a", "b") if (m + len(h)) % 3 or h == "a"]
    folder = scratch_path(spark, "both")
    put(folder, 1, *messages)
    put(folder, 2, message(9000, "end"))
    good = source.good_events(stream(spark, folder))
    out = sinks.run_to_end(spark, {"s": windows.sessions(good, T, ["ip", "host"])})["s"].filter("host <> 'end'")
    table = source.good_events(source.parse_messages(spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")))
    for slice_seconds in (60, 3600):
        batch = windows.sessions_of_table(table, T, ["ip", "host"], 300, slice_seconds)
        assert rows(batch) == rows(out, *batch.columns)
    means = dict(rows(windows.session_means(batch), "host", "avg_events"))
    assert means["(overall)"] == len(messages) / batch.count()


def test_restart_continues_without_repeats(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("restart", "restart-out", "restart-cp"))
    put(folder, 1, message(1), message(2))

    def start():
        return run(sinks.start_append(source.good_events(stream(spark, folder)).select("host", T), out, checkpoint))

    start()
    put(folder, 2, message(3, "b"))
    start()
    start()
    assert rows(spark.read.parquet(out), "host") == [("a",), ("a",), ("b",)]


def test_batch_sink_is_idempotent(spark):
    folder, out = scratch_path(spark, "idem"), scratch_path(spark, "idem-out")
    put(folder, 1, message(1))
    put(folder, 2, message(2))
    for _ in range(2):  # a lost checkpoint replays every batch under the same ids
        rowsets = source.good_events(stream(spark, folder)).select("host", T)
        run(sinks.start_batches(rowsets, out, scratch_path(spark, "idem-cp")))
    back = sinks.batch_rows(spark, out, ["host", T], f"host string, {T} timestamp")
    assert back.count() == 2


def test_message_sink_keeps_nulls(spark):
    folder, out = scratch_path(spark, "msg"), scratch_path(spark, "msg-out")
    put(folder, 1, message(1))
    good = source.good_events(stream(spark, folder)).select("ip", "referrer", "host")
    run(sinks.start_messages(good, "text", {"path": out}, scratch_path(spark, "msg-cp")))
    lines = [json.loads(r[0]) for r in spark.read.text(out).collect()]
    assert lines == [{"ip": "1.1.1.1", "referrer": None, "host": "a"}]


def test_running_trigger_commits_and_stops(spark):
    folder, out = scratch_path(spark, "every"), scratch_path(spark, "every-out")
    put(folder, 1, message(1))
    query = sinks.start_append(
        source.good_events(stream(spark, folder)).select("host"), out, scratch_path(spark, "every-cp"), every="100 milliseconds"
    )
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(out).count() == 1


def test_table_stream_reads_file_and_folder(spark, small):
    one = f"{small}/events.parquet"
    n = spark.read.parquet(one).count()
    folder = scratch_path(spark, "folder.parquet")
    spark.read.parquet(one).repartition(3).write.parquet(folder)
    for path in (one, folder):
        got = sinks.run_to_end(spark, {"t": source.read_table_stream(spark, path)})["t"]
        assert got.count() == n


def test_hits_of_a_hot_key_are_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([(BASE, "a")] * 10, "t timestamp, host string")
    plan = windows.tumbling_hits(df, "t", ["host"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert df.select(F.max("t")).first()[0] == BASE


EVENT = "host string, event_time timestamp"


def hits(spark, *minutes):
    return spark.createDataFrame([(h, None if m is None else BASE + timedelta(minutes=m)) for h, m in minutes], EVENT)


def test_late_rows_are_those_that_the_windows_drop(spark):
    batches = [
        hits(spark, ("a", 1), ("b", 4.9)),
        hits(spark, ("a", 3), ("a", 21), ("b", None)),
        hits(spark, ("a", 4), ("b", 19.9), ("b", 20)),  # the first two are late: their windows ended before 21 minutes less 15 seconds
        hits(spark, ("b", 10_000)),
    ]
    split = late.LateSplit(spark, scratch_path(spark, "split"), EVENT)
    folder, out = scratch_path(spark, "same"), None
    windowed = {}
    for number, batch in enumerate(batches):
        for _ in range(2):  # a repeated batch replaces itself
            split.take(batch, number)
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream = windows.tumbling_hits(spark.readStream.schema(EVENT).parquet(folder), "event_time", ["host"])
        out = windowed.setdefault("out", scratch_path(spark, "same-out"))
        run(sinks.start_append(stream, out, windowed.setdefault("point", scratch_path(spark, "same-point"))))
    got = split.rows()
    assert rows(got.filter("late and event_time is not null"), "host", "batch_id") == [("a", 2), ("b", 2)]
    assert got.count() == 9 and got.filter("late").count() == 3
    kept = windows.tumbling_hits(got.filter("not late"), "event_time", ["host"]).filter("window_start < '2024-01-02'")
    assert rows(spark.read.parquet(out), *kept.columns) == rows(kept)


def test_no_batch_no_rows(spark):
    assert late.LateSplit(spark, scratch_path(spark, "nothing"), EVENT).rows().count() == 0


def test_open_windows_are_in_the_state_at_each_stop(spark):
    other = recovery.stream_session(spark)
    parts = [hits(other, ("a", 1), ("b", 4)), hits(other, ("a", 2), ("a", 7)), hits(other, ("b", 8), ("b", 13)), hits(other, ("a", 10_000))]
    stops = []

    def seen(out, state):
        keys = {(r.key.window.start, r.key.host) for r in state.collect()}
        stops.append(({(r.window_start, r.host) for r in out.collect()}, keys))

    read = lambda path: other.readStream.schema(EVENT).parquet(path)
    out = recovery.run_in_stretches(other, parts, read, lambda df: windows.tumbling_hits(df, "event_time", ["host"]), "stops", seen)
    known = set()
    for (done, held), part in zip(stops, ([("a", 0), ("b", 0)], [("a", 5)], [("b", 5), ("b", 10)], [("a", 10_000)])):
        known |= {(BASE + timedelta(minutes=m), h) for h, m in part}
        assert done | held == known and not done & held
    assert len(stops[0][1]) == 2 and len(stops[1][0]) == 2
    assert rows(out) == as_set([(BASE, "a", 2), (BASE, "b", 1), (BASE + timedelta(minutes=5), "a", 1), (BASE + timedelta(minutes=5), "b", 1), (BASE + timedelta(minutes=10), "b", 1)])


def test_sessions_go_on_over_a_stop(spark):
    other = recovery.stream_session(spark)
    parts = [hits(other, ("a", 0), ("a", 4)), hits(other, ("a", 8), ("b", 9)), hits(other, ("a", 12), ("a", 40)), hits(other, ("b", 10_000))]
    read = lambda path: other.readStream.schema(EVENT).parquet(path)
    out = recovery.run_in_stretches(other, parts, read, lambda df: windows.sessions(df, "event_time", ["host"]), "over")
    assert rows(out, "host", "num_events") == [("a", 1), ("a", 4), ("b", 1)]


def test_the_callers_settings_stay(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    assert recovery.stream_session(spark).conf.get(name) == recovery.ROCKSDB
    assert spark.conf.get(name) == before
