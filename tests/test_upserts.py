"""Upserts by key into partitioned tables."""

from __future__ import annotations

import os
import re

import pytest

from helpers import rows
from ledgerline.plans import inspect
from ledgerline.session import scratch_path
from ledgerline.sources import upserts

SCHEMA = "id long, day string, kind string, n long"
KEYS, BY = ["id", "day", "kind"], ["day", "kind"]
OLD = [(i, f"d{i % 3}", k, i) for i in range(9) for k in ("a", "b")] + [(None, "d0", "a", 7), (1, None, "a", 1)]
NEW = [(3, "d0", "a", 300), (100, "d0", "a", 1), (100, "d9", "c", 2), (1, None, "a", 50)]


def merged(old, new):
    held = {r[:3]: r for r in old}
    held.update({r[:3]: r for r in new})
    return sorted(held.values(), key=repr)


@pytest.fixture
def path(spark):
    path = scratch_path(spark, "upserts")
    upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame(OLD, SCHEMA), KEYS, BY)
    return path


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_first_run_starts_the_table(spark, path):
    assert rows(spark.read.schema(SCHEMA).parquet(path), "id", "day", "kind", "n") == sorted(OLD, key=repr)


def test_an_upsert_and_its_repetition(spark, path):
    # rows whose key has a null match no other row
    want = merged([r for r in OLD if None not in r[:3]], [r for r in NEW if None not in r[:3]])
    for _ in range(2):
        got = upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame([r for r in NEW if None not in r], SCHEMA), KEYS, BY)
        assert rows(got.dropna()) == want
        assert rows(got.filter("id is null or day is null")) == sorted([r for r in OLD if None in r[:3]], key=repr)


def test_other_partitions_keep_their_files(spark, path):
    before = files_of(path)
    upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame(NEW[:2], SCHEMA), KEYS, BY)
    touched = {f for f in before if "day=d0/kind=a" in f}
    assert touched and before - files_of(path) == touched


def test_untouched_partitions_are_not_read(spark, path):
    old = spark.read.schema(SCHEMA).parquet(path)
    plan = inspect.plan_text(upserts.merged_partitions(old, spark.createDataFrame(NEW[:2], SCHEMA), KEYS, BY))
    [scan] = re.findall(r"PartitionFilters: \[(.*?)\],", plan)
    assert "day" in scan and "= d0" in scan and "kind" in scan
    merged_rows = upserts.merged_partitions(old, spark.createDataFrame(NEW[:2], SCHEMA), KEYS, BY)
    assert {r["day"] for r in merged_rows.collect()} == {"d0"}


def test_two_rows_for_a_key_are_refused(spark, path):
    with pytest.raises(ValueError, match="two new rows"):
        upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame(NEW[:1] * 2, SCHEMA), KEYS, BY)


def test_partition_columns_belong_to_the_key(spark, path):
    with pytest.raises(ValueError, match="among the keys"):
        upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame(NEW, SCHEMA), ["id"], BY)


def test_no_new_rows(spark, path):
    before = files_of(path)
    upserts.upsert_table(spark, path, SCHEMA, spark.createDataFrame([], SCHEMA), KEYS, BY)
    assert files_of(path) == before
