"""Plans of registered queries: what is read, and what moves."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from ledgerline.plans import inspect


@pytest.mark.parametrize(
    "name", ["d1_cumulate_step", "d10_scd2_incremental", "d12_actors_cumulative", "d14_actors_scd_incr", "f6_active_dates", "f15_monthly_hits", "a1_growth_step", "s17_partition_filter"]
)
def test_steps_read_one_partition(spark, small, name):
    plan = inspect.plan_text(contract.queries()[name](spark, small))
    assert re.search(r"PartitionFilters: \[[^\]]", plan)


@pytest.mark.parametrize("name", ["d1_cumulate_step", "d10_scd2_incremental", "d14_actors_scd_incr", "f15_monthly_hits", "a1_growth_step"])
def test_steps_read_no_other_partition(spark, small, name):
    """No scan of a stored table stands beside the one of the wanted snapshot."""
    plan = inspect.plan_text(contract.queries()[name](spark, small))
    stored = [s for s in re.findall(r"FileScan parquet .*?ReadSchema", plan, re.S) if "/root/testdata" not in s]
    assert stored and all("PartitionFilters: []" not in s for s in stored)


@pytest.mark.parametrize("name", ["s12_bucket_join", "s14_three_way", "s17_partition_filter"])
def test_bucketed_tables_join_where_they_lie(spark, small, name):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = inspect.plan_text(contract.queries()[name](spark, small))
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning\([^)]*match_id[^)]*, ENSURE", plan.split("HashAggregate")[-1])
    assert not re.search(r"Exchange hashpartitioning\(match_id#\d+L?, part#\d+, player", plan)


def test_stored_tables_are_written_once(spark, small):
    first = contract.queries()["s12_bucket_join"](spark, small)
    tables = len(spark.catalog.listTables())
    second = contract.queries()["s12_bucket_join"](spark, small)
    assert len(spark.catalog.listTables()) == tables and first.count() == second.count()


@pytest.mark.parametrize(
    "name", ["f1_duplicate_keys", "q1_unique_key", "a6_game_sets", "a6_winners", "a10_longest_streak", "g8_pair_vs_career", "g9_plays_on"]
)
def test_details_are_joined_and_grouped_in_tasks_of_bounded_size(spark, small, name):
    """Both sides of the join by game are dealt out by number; adaptive execution does not join those partitions."""
    plan = inspect.plan_text(contract.queries()[name](spark, small))
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, \d+\), REPARTITION_BY_NUM", plan)
    assert re.search(r"hashpartitioning\(game_id#\d+L, \d+\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"hashpartitioning\(l_orderkey#\d+L, \d+\), ENSURE", plan.split("Union")[0] if name == "q1_unique_key" else plan.split("max(player_name")[0])


@pytest.mark.parametrize("name, key", [("d10_scd2_incremental", "player_name"), ("d14_actors_scd_incr", "actorid")])
def test_histories_are_built_in_tasks_of_bounded_size(spark, small, name, key):
    assert re.search(rf"hashpartitioning\({key}#\d+L?, \d+\), REPARTITION_BY_NUM", inspect.plan_text(contract.queries()[name](spark, small)))


def test_pairs_join_careers_without_their_maps(spark, small):
    plan = inspect.plan_text(contract.queries()["g8_pair_vs_career"](spark, small))
    top = re.search(r"\w+Join", plan).start()
    assert "properties" not in plan[:top] and re.search(r"properties#\d+\[subject_points\]", plan[top:])


def test_layouts_read_the_joined_rows_from_store(spark, small, monkeypatch):
    from ledgerline.sources import files, layout

    stored, seen, keep = [], [], files.stored
    monkeypatch.setattr(files, "stored", lambda df, label: stored.append(label) or keep(df, label))
    order = layout.in_equal_files
    monkeypatch.setattr(layout, "in_equal_files", lambda df, *args: seen.append(inspect.plan_text(df)) or order(df, *args))
    contract.queries()["s11_layout_study"](spark, small)
    assert stored == ["matches-joined"] and len(seen) == 4
    assert all("Join" not in plan for plan in seen)
