from __future__ import annotations

import re
from functools import partial

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import as_set, rows, settled
from ledgerline.functions.columns import QUALITY_LADDER, SCORING_LADDER, ladder
from ledgerline.operators import dims, growth, scd, stretches
from ledgerline.plans import inspect
from ledgerline.sources.files import write_partitioned

scoring = partial(ladder, steps=SCORING_LADDER)
quality = partial(ladder, steps=QUALITY_LADDER)
SEASON = "name string, college string, season int, gp int, pts double"
EMPTY = (
    "name string, college string, history array<struct<season:int,gp:int,pts:double>>, class string, "
    "years_since_last_active int, is_active boolean, current int"
)
DATA = [
    ("A", "x", 1996, 10, 21.0),
    ("A", "x", 1997, 11, 9.0),
    ("A", "x", 1999, 12, 16.0),
    ("B", "y", 1998, 5, 0.0),
    ("B", "y", 1999, 6, 12.0),
]


def step(prev, today, year):
    return dims.cumulate_step(
        prev, today, "name", ["college"], ["season", "gp", "pts"], "season", year, "pts", scoring
    )


def backfill(df, last):
    return dims.cumulate_backfill(df, "name", "season", last, ["college"], ["season", "gp", "pts"], "pts", scoring)


def test_struct_fields_are_matched_by_name(spark):
    df = spark.createDataFrame(DATA, SEASON)
    first = backfill(df, 1996).first()["history"][0]
    assert (first["season"], first["gp"], first["pts"]) == (1996, 10, 21.0)


def test_folded_steps_equal_backfill(spark):
    df = spark.createDataFrame(DATA, SEASON)
    snapshot = spark.createDataFrame([], EMPTY)
    everything = backfill(df, 2000)
    for year in range(1996, 2001):
        snapshot = settled(step(snapshot, df.filter(F.col("season") == year), year))
        want = everything.filter(F.col("current") == year)
        assert rows(snapshot, *want.columns) == rows(want)


def test_one_snapshot_equals_the_last_of_all(spark):
    df = spark.createDataFrame(DATA, SEASON)
    for year in (1998, 2000):
        only = dims.cumulate_backfill(
            df, "name", "season", year, ["college"], ["season", "gp", "pts"], "pts", scoring, only_last=True
        )
        want = backfill(df, year).filter(F.col("current") == year)
        assert rows(only, *want.columns) == rows(want)


def test_backfill_uses_one_shuffle_and_no_theta_join(spark):
    plan = inspect.plan_text(backfill(spark.createDataFrame(DATA, SEASON), 2000))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "Window" not in plan


def test_inactive_years(spark):
    got = rows(backfill(spark.createDataFrame(DATA, SEASON), 2000), "name", "current", "class", "is_active", "years_since_last_active")
    assert ("A", 1998, "bad", False, 1) in got
    assert ("A", 1999, "good", True, 0) in got
    assert ("A", 2000, "good", False, 1) in got


def test_ratio_counts_zero_first_value_as_one(spark):
    snapshot = backfill(spark.createDataFrame(DATA, SEASON), 1999).filter("current = 1999")
    got = dict(rows(dims.last_to_first_ratio(snapshot, "name", "pts")))
    assert got == {"A": 16.0 / 21.0, "B": 12.0}


def test_explode_history(spark):
    snapshot = backfill(spark.createDataFrame(DATA, SEASON), 1999).filter("current = 1999")
    assert rows(dims.explode_history(snapshot, "name"), "name", "season") == [(d[0], d[2]) for d in DATA]


FILMS = "actor int, film string, year int, rating int, filmid string"
FILM_ROWS = [(1, f"f{i}", 2000 + i % 3, i % 11, f"id{i}") for i in range(60)] + [(2, "g", 2001, 9, "g1")]


ITEMS = ("film", "rating", "filmid")


def folded(df, first, last, width, max_rows=100_000):
    """Closed stretches and snapshots of all years by steps, and the snapshot before the first."""
    args = ("actor", "year", ITEMS, "rating")
    closed, snapshot = stretches.history_backfill(df, *args, first, quality, width, max_rows)
    closed, snapshots = settled(closed), [settled(snapshot)]
    for year in range(first + 1, last + 1):
        more, snapshot = stretches.history_step(snapshots[-1], df, *args, year, quality, width, max_rows)
        closed, snapshots = settled(closed.unionByName(more)), [*snapshots, settled(snapshot)]
    return closed, snapshots


@pytest.mark.parametrize("width", [1, 4, 20, 1000])
def test_film_steps_equal_the_backfill(spark, width):
    df = spark.createDataFrame(FILM_ROWS, FILMS)
    closed, snapshots = folded(df, 1999, 2003, width)
    for year, snapshot in zip(range(1999, 2004), snapshots):
        whole = stretches.history_backfill(df, "actor", "year", ITEMS, "rating", year, quality, width)
        assert rows(snapshot, *whole[1].columns) == rows(whole[1])
        assert rows(closed.filter(F.col("closed_in") <= year), *whole[0].columns) == rows(whole[0])
        assert snapshot.filter(F.size("items") >= width).count() == 0


def test_all_films_in_order_in_bounded_rows(spark):
    many = [(7, f"big{i % 50}", 2000 + i % 3, i % 11, f"big{i:05}") for i in range(3000)]
    data = [*FILM_ROWS, *many, *many[:5], (8, "no rating", 2000, None, "n1"), (None, "no actor", 2000, 1, "n2"), (9, "no year", None, 1, "n3")]
    df = spark.createDataFrame(data, FILMS)
    closed, snapshots = folded(df, 1999, 2002, 100)
    got = stretches.whole_history(closed, snapshots[-1], "actor", 2002, 100)
    assert got.filter("actor = 7").count() == 31 and got.filter(F.size("items") > 100).count() == 0
    for actor in (1, 2, 7, 8):
        items = [tuple(i) for r in sorted(got.filter(F.col("actor") == actor).collect(), key=lambda r: r.stretch) for i in r["items"]]
        mine = [(y, f, r, i) for a, f, y, r, i in data if a == actor and y is not None]
        assert items == sorted(mine, key=lambda t: (t[0], t[1], t[2] is not None, t[2] or 0, t[3]))
    assert {r.actor for r in got.collect()} == {1, 2, 7, 8}


def test_a_large_year_is_numbered_in_parts(spark):
    many = [(7, f"f{i}", 2000 + i // 1000, i % 11, f"id{i:05}") for i in range(2000)]
    df = spark.createDataFrame(many + FILM_ROWS, FILMS)
    numbered = stretches.number_items(df, "actor", "year", ITEMS, max_rows=64)
    for actor, n in ((7, 2000), (1, 60)):
        mine = sorted(numbered.filter(F.col("actor") == actor).select("ordinal", "year").collect())
        assert [r.ordinal for r in mine] == list(range(n))
        assert [r.year for r in mine] == sorted(r.year for r in mine)
    closed, snapshots = folded(df, 1999, 2002, 100, max_rows=64)
    whole = stretches.history_backfill(df, "actor", "year", ITEMS, "rating", 2002, quality, 100, 64)
    assert rows(closed, *whole[0].columns) == rows(whole[0]) and rows(snapshots[-1], *whole[1].columns) == rows(whole[1])


def test_a_step_reads_no_closed_stretch_and_one_snapshot(spark, tmp_path):
    df = spark.createDataFrame(FILM_ROWS, FILMS)
    both = [stretches.history_backfill(df, "actor", "year", ITEMS, "rating", y, quality, 8)[1] for y in (2000, 2001)]
    path = write_partitioned(both[0].unionByName(both[1]), str(tmp_path / "actors"), ["current"])
    prev = spark.read.schema(both[0].schema).parquet(path)
    closed, snapshot = stretches.history_step(prev, df, "actor", "year", ITEMS, "rating", 2002, quality, 8)
    for step in (closed, snapshot):
        plan = inspect.plan_text(step)
        scans = re.findall(r"PartitionFilters: \[.*?\]", plan)
        assert scans and all("current" in s and "= 2001" in s for s in scans)


def test_film_totals_add_up_without_lists(spark):
    data = [*FILM_ROWS, *[(3, "h", 2000 + i % 4, i % 11, f"h{i:04}") for i in range(2000)], (4, "n", 2000, None, None)]
    df = spark.createDataFrame(data, FILMS)
    args = ("actor", "year", "rating")
    totals = {"sums": {"rating": "ratings"}, "ends": {"filmid": ("first", "last")}}
    snapshot = dims.films_totals(df, *args, 1999, quality, **totals)
    for year in (2000, 2001, 2002, 2003):
        snapshot = settled(step := dims.films_totals_step(snapshot, df, *args, year, quality, **totals))
        whole = dims.films_totals(df, *args, year, quality, **totals)
        assert rows(snapshot, *whole.columns) == rows(whole)
        assert "collect_list" not in inspect.plan_text(step) + inspect.plan_text(whole)
    for actor in (1, 2, 3, 4):
        mine = [r for r in data if r[0] == actor]
        rated, ids = [r[3] for r in mine if r[3] is not None], [r[4] for r in mine if r[4] is not None]
        want = (actor, len(mine), sum(rated) if rated else None, min(ids, default=None), max(ids, default=None))
        assert want in rows(snapshot, "actor", "n_items", "ratings", "first", "last")
    listed = stretches.history_backfill(df, "actor", "year", ["filmid"], "rating", 2003, quality)[1]
    states = ("actor", "quality_class", "is_active")
    assert rows(snapshot, *states) == rows(listed, *states)


def test_totals_query_collects_no_items(spark, small):
    from ledgerline.catalog import q_dims

    plan = inspect.plan_text(q_dims.d12_totals(spark, small))
    assert "collect_list" not in plan and "items" not in plan


def test_film_step_refuses_another_year(spark):
    df = spark.createDataFrame(FILM_ROWS, FILMS)
    args = ("actor", "year", ITEMS, "rating")
    snapshot = settled(stretches.history_backfill(df, *args, 2001, quality)[1])
    with pytest.raises(Exception, match="needs the snapshot of 2002"):
        stretches.history_step(snapshot, df, *args, 2003, quality)


def test_yearly_quality_agrees_with_film_histories(spark):
    df = spark.createDataFrame(FILM_ROWS, FILMS)
    yearly = dims.yearly_quality(df, "actor", "year", "rating", 2003, quality).filter("current_year = 2002")
    whole = stretches.history_backfill(df, "actor", "year", ["filmid"], "rating", 2002, quality)[1]
    states = ("actor", "quality_class", "is_active")
    assert rows(yearly, *states) == rows(whole, *states)


# -- type-2 histories -------------------------------------------------------

PLAYER = "player_name string, current_season long, scoring_class string"


def test_runs_of_classes_of_several_entities(spark):
    runs = {"Ida": "ssgggsab", "Jon": "b", "Kim": "abab"}
    data = [(name, 1980 + i, c) for name, classes in runs.items() for i, c in enumerate(classes)]
    got = rows(scd.scd2_backfill(spark.createDataFrame(data, PLAYER), "player_name", "current_season", ["scoring_class"]))
    for name, classes in runs.items():
        mine = sorted((start, end, c) for n, c, start, end in got if n == name)
        assert "".join(c * (end - start + 1) for start, end, c in mine) == classes
        assert all(a[2] != b[2] and a[1] + 1 == b[0] for a, b in zip(mine, mine[1:]))


def test_null_is_a_value_and_gaps_do_not_break(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 2, None), ("A", 5, "x"), ("A", 9, "x"), ("A", 10, None)], PLAYER)
    got = rows(scd.scd2_backfill(df, "player_name", "current_season", ["scoring_class"]))
    assert got == as_set([("A", None, 1, 2), ("A", "x", 5, 9), ("A", None, 10, 10)])


def test_change_flags(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, "x"), ("A", 3, None), ("A", 4, None)], PLAYER)
    out = scd.change_indicators(df, "player_name", "current_season", ["scoring_class"])
    assert [f for *_, f in rows(out, "current_season", "scoring_class_changed")] == [1, 0, 1, 0]


def test_incremental_cases(spark):
    prev = spark.createDataFrame(
        [
            ("same", "x", 2018, 2020, 2020),
            ("moved", "x", 2019, 2020, 2020),
            ("moved", "w", 2017, 2018, 2020),
            ("gone", "x", 2020, 2020, 2020),
            ("tonull", "x", 2020, 2020, 2020),
        ],
        "k string, c string, start_period int, end_period int, current int",
    )
    now = spark.createDataFrame(
        [("same", 2021, "x"), ("moved", 2021, "y"), ("fresh", 2021, "x"), ("tonull", 2021, None)], "k string, p int, c string"
    )
    got = rows(scd.scd2_incremental(prev, now, "k", "p", ["c"], 2021), "k", "c", "start_period", "end_period", "current")
    want = [
        ("same", "x", 2018, 2021, 2021),
        ("moved", "w", 2017, 2018, 2021),
        ("moved", "x", 2019, 2020, 2021),
        ("moved", "y", 2021, 2021, 2021),
        ("gone", "x", 2020, 2020, 2021),
        ("tonull", "x", 2020, 2020, 2021),
        ("tonull", None, 2021, 2021, 2021),
        ("fresh", "x", 2021, 2021, 2021),
    ]
    assert got == as_set(want)
    dropped = scd.scd2_incremental(prev, now, "k", "p", ["c"], 2021, drop_absent=True)
    assert dropped.filter("k = 'gone'").count() == 0


def test_incremental_reads_one_of_several_stored_snapshots(spark):
    data = [("x", p, "on" if p < 2001 else "off") for p in range(1999, 2003)]
    df = spark.createDataFrame(data, "k string, p int, c string")
    stored = scd.scd2_backfill(df, "k", "p", ["c"], 1999)
    for year in (2000, 2001):
        stored = stored.unionByName(scd.scd2_backfill(df, "k", "p", ["c"], year))
    now = scd.scd2_incremental(stored, df, "k", "p", ["c"], 2002)
    assert rows(now, "k", "c", "start_period", "end_period", "current") == rows(
        scd.scd2_backfill(df, "k", "p", ["c"], 2002), "k", "c", "start_period", "end_period", "current"
    )
    with pytest.raises(Exception, match="needs the snapshot of 2003"):
        scd.scd2_incremental(stored, df, "k", "p", ["c"], 2004).collect()


def test_cumulate_step_refuses_another_snapshot(spark):
    df = spark.createDataFrame(DATA, SEASON)
    stored = backfill(df, 1998)
    want = backfill(df, 1999).filter("current = 1999")
    assert rows(step(stored, df.filter("season = 1999"), 1999), *want.columns) == rows(want)
    with pytest.raises(Exception, match="needs the snapshot of 1999"):
        step(stored, df.filter("season = 2000"), 2000).collect()


def test_compare_statuses(spark):
    open_rows = spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "k string, c string, start_period int")
    now = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "k string, c string")
    got = rows(scd.scd2_compare(open_rows, now, "k", ["c"]), "k", "status")
    assert got == [("a", "unchanged"), ("b", "changed"), ("c", "new")]


snapshots = st.lists(st.lists(st.sampled_from(["x", "y", None]), min_size=5, max_size=5), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None)
@given(snapshots)
def test_folded_increments_equal_backfill_and_cover_all_rows(spark, values):
    data = [(k, p, v) for k, row in enumerate(values) for p, v in enumerate(row)]
    df = spark.createDataFrame(data, "k int, p int, c string")
    history = scd.scd2_backfill(df, "k", "p", ["c"], 0)
    for period in range(1, 5):
        history = settled(scd.scd2_incremental(history, df, "k", "p", ["c"], period))
    whole = rows(scd.scd2_backfill(df, "k", "p", ["c"], 4), "k", "c", "start_period", "end_period", "current")
    assert rows(history, "k", "c", "start_period", "end_period", "current") == whole
    covered = [(k, p, c) for k, c, s, e, _ in whole for p in range(s, e + 1)]
    assert as_set(covered) == as_set(data)


def test_state_changes(spark):
    df = spark.createDataFrame(
        [("A", 1, True), ("A", 2, False), ("A", 3, False), ("A", 4, True), ("A", 5, True)], "k string, p int, on boolean"
    )
    got = [s for *_, s in rows(growth.state_changes(df, "k", "p", "on"))]
    assert got == ["New", "Retired", "Stayed Retired", "Returned from Retirement", "Continued Playing"]


def test_ordinary_actors_are_numbered_and_listed_in_one_shuffle(spark):
    many = [(7, f"f{i}", 2000 + i // 1000, i % 11, f"id{i:05}") for i in range(2000)]
    df = spark.createDataFrame(many + FILM_ROWS, FILMS)
    small, large = stretches._numbered_apart(df, "actor", "year", ITEMS, 64)
    whole = stretches.number_items(df, "actor", "year", ITEMS, max_rows=64)
    assert rows(small.unionByName(large), *whole.columns) == rows(whole)
    assert {r.actor for r in large.select("actor").distinct().collect()} == {7}
    listed = inspect.plan_text(stretches._stretches(small, "actor", "year", ITEMS, 8))
    # one exchange of rows and one of the counts that tell large actors
    assert len(re.findall(r"Exchange hashpartitioning", listed)) == 2
