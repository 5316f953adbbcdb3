"""Archives: what is written is valid gzip and WARC, and comes back whole whatever the ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import warc
from ledgerline.session import scratch_path

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>two ü日本</p>" * 50),
    (3, "http://a/3", "<p>one</p>"),
    (4, None, None),
    (5, "http://a/5\r\nX-Evil: 1", ""),
    (6, "http://a/6", "\r\n\r\nWARC/1.1\r\n\r\n\x1f"),
    (None, "http://a/n", "<p>one</p>"),
    (None, "http://a/m", "only without id"),
    (7, "http://a/7", "twice"),
    (7, "http://a/7", "twice"),
    (8, "http://a/8", "".join(random.Random(3).choices("abcdefghij <>/", k=400_000))),
]


def brute(rows, least: int = 0):
    first = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= least:
            first[raw] = max(page, first.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        other = first.get(raw) if first.get(raw) != page else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "response" if other is None else "revisit", other))
    return sorted(out, key=str)


def back(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, SCHEMA)
    for name in ("kind", "first", "print", "n", "offset", "record_type", "payload_bytes", "value"):
        rows = rows.withColumn(name, F.lit("other"))
    return rows


@pytest.mark.parametrize("size", [100, 4096, 32 << 20])
def test_round_trip(spark, pages, size):
    assert back(warc.round_trip(pages, range_bytes=size)) == brute(PAGES)


def test_short_payloads_are_responses(pages):
    assert back(warc.round_trip(pages, least_bytes=6)) == brute(PAGES, 6)


def test_given_table_with_copies(spark, small):
    rows = spark.read.parquet(f"{small}/pages.parquet")
    both = rows.unionByName(rows.withColumn("page_id", F.col("page_id") + 100_000).limit(60))
    want = brute([(r.page_id, r.url, r.html) for r in both.collect()])
    assert back(warc.round_trip(both.repartition(7), range_bytes=10_000)) == want


def test_a_hot_payload(spark):
    rows = [(i, f"http://a/{i}", "same" if i % 3 == 0 else f"other {i}") for i in range(900)]
    assert back(warc.round_trip(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def archives(spark, pages):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages.repartition(2), path)
    return path


def files_of(path):
    return [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-")]


def test_files_are_plain_gzip_with_one_record_a_member(archives):
    records = 0
    for file in files_of(archives):
        raw = open(file, "rb").read()
        text = gzip.GzipFile(fileobj=io.BytesIO(raw)).read()
        while raw:
            unpacker = zlib.decompressobj(31)
            record = unpacker.decompress(raw)
            assert record.startswith(b"WARC/1.1\r\n") and text.startswith(record)
            text, raw, records = text[len(record) :], unpacker.unused_data, records + 1
        assert text == b""
    assert records == len(PAGES)


def test_records_have_headers_blocks_and_payloads(spark, archives):
    rows = warc.read_records(spark, archives, 700, with_payload=True).collect()
    assert len(rows) == len(PAGES)
    assert len({(r.file, r.offset) for r in rows}) == len(rows)
    texts = sorted(bytes(r.payload).decode() for r in rows if r.record_type == "response")
    assert texts == sorted(["<p>one</p>", PAGES[1][2], "", PAGES[5][2], "only without id", "twice", "twice", PAGES[10][2]])
    by_page = {r.page_id: r for r in rows}
    assert by_page[5].target_uri == "http://a/5%0D%0AX-Evil:%201" and by_page[4].target_uri is None
    assert by_page[1].refers_to_id == by_page[3].record_id and by_page[1].payload is None


def test_a_record_whose_last_byte_is_not_zero():
    raw = b"x" * (17 << 20)
    member = warc._member(raw, 1)
    assert member[-1] == 0 and gzip.decompress(member) == raw


def source(raw: bytes) -> warc.Source:
    return warc.Source(lambda at, size: raw[at : at + size])


def test_every_split_yields_every_record_once(monkeypatch):
    monkeypatch.setattr(warc, "AHEAD", 64)
    monkeypatch.setattr(warc, "WINDOW", 32)
    record = [warc._member(warc._record("response", i, "u", None, os.urandom(90) + warc.MAGIC + os.urandom(60), "d"), 0) for i in range(9)]
    other = gzip.compress(b"not an archive " * 20)
    raw = record[0] + other + b"".join(record[1:5]) + b"padding" + warc.MAGIC + b"".join(record[5:])
    for step in (1, 7, 50, 333, len(raw)):
        found = [h["page-id"] for a in range(0, len(raw), step) for _, h, _ in warc.records_in(source(raw), a, min(len(raw), a + step))]
        assert found == [str(i) for i in range(9)]


def test_damaged_records_are_errors():
    good = warc._member(warc._record("response", 1, "u", None, b"some payload " * 30, "d"), 6)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_in(source(good[:-9]), 0, len(good)))
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records_in(source(good[:-6] + b"\1\2" + good[-4:]), 0, len(good)))
    wrong = warc._record("response", 1, "u", None, b"payload", "d").replace(b"\r\n\r\npayload", b"\r\n\r\npaYload")
    [(at, headers, block)] = warc.records_in(source(warc._member(wrong, 6)), 0, 10)
    with pytest.raises(ValueError, match="digest"):
        warc._row("f", at, headers, block, False)
