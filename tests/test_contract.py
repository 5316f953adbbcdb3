"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
from ledgerline.plans import inspect  # noqa: E402

# The training-data queries have tests of their own, which go with them.
OWN = sorted(n for n in contract.queries() if contract.llm is None or n not in {*contract.llm.QUERIES, "pipeline"})
# Thresholds and single days that the smallest tables never reach.
MAY_BE_EMPTY = {"a8_rolling", "a8_rolling_calendar", "s17_partition_filter"}


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "daily_active_state" in df.columns


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {n for n in OWN if n not in contract.oracle_sql()} == set()


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, small, name):
    good, note = compare.compare(spark, con, small, name, contract.queries()[name], contract.oracle_sql().get(name))
    assert good or (name in MAY_BE_EMPTY and note.startswith("0 rows equal")), note


@pytest.mark.parametrize("name", sorted(set(OWN) - {"t12_two_outputs"}))
def test_no_cross_join_and_no_python_in_any_plan(spark, small, name):
    df = contract.queries()[name](spark, small)
    assert not inspect.has_cross_join(df) and not inspect.uses_python(df)
