from __future__ import annotations

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import substrings


def got_of(df, **options):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(df, **options).collect()}


def want_of(rows):
    return {doc: (n, gone, brute.sha(" ".join(kept))) for doc, (n, gone, kept) in brute.without_repeats(rows).items()}


@pytest.mark.parametrize("most", [substrings.MOST, 3])
def test_small_table(docs, plain, most):
    assert got_of(docs, most=most) == want_of(plain)


PASSAGE = st.sampled_from([" ".join(f"{p}{i}" for i in range(n)) for p, n in (("a", 25), ("b", 40), ("c", 19))] + ["x", "y z", "x x x"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(PASSAGE, max_size=12).map(" ".join), min_size=5, max_size=12))
def test_shared_passages(spark, texts):
    rows = list(enumerate(texts))
    assert got_of(spark.createDataFrame(rows, "doc_id long, text string")) == want_of(rows)


@pytest.mark.parametrize("period", [1, 3, 7, 30])
def test_repeats_inside_one_text(spark, period):
    rows = [(1, " ".join(f"p{i % period}" for i in range(95)))]
    assert got_of(spark.createDataFrame(rows, "doc_id long, text string")) == want_of(rows)


def test_owner_depends_on_the_window_alone():
    words = [f"w{i}".encode() for i in range(60)]
    whole = substrings.owners(substrings.phrase_hashes(words))
    for at in range(41):
        assert substrings.owners(substrings.phrase_hashes(words[at : at + 20]))[0] == whole[at]


def test_text_and_carried_columns(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{passage}\n tail", "a"), (2, f"head  {passage}", "b"), (3, "kept  as is", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.kept_text, r.source) for r in substrings.remove_repeats(df, with_text=True, carry=("source",)).collect()}
    assert got == {1: (f"{passage}\n tail", "a"), 2: ("head", "b"), 3: ("kept  as is", None)}


def test_odd_rows(odd):
    got = substrings.remove_repeats(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_words == by_id[2].n_words == 0 and by_id[7].n_removed == 30_000
    assert by_id[1].kept_sha256 == brute.sha("")
    assert [r.n_removed for r in got if r.doc_id == 8] == [0, 0]


def test_repeated_row_with_id_is_one_place(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = substrings.remove_repeats(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.n_removed) for r in got.collect()) == [(0, 0), (1, 30), (1, 30)]


def test_empty_table(none):
    assert substrings.remove_repeats(none).collect() == []
