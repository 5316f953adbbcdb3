"""Spelling variants against a plain version over all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, least: int = 5) -> dict[str, int]:
    found = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def judged(words: dict[str, int]) -> set[tuple]:
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}
    out = set()
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.add((word, form.get(word), root, n, len(near[word]), words[form[word]] if word in form else None))
    return out


def of(spark, rows, **options) -> set[tuple]:
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return set(map(tuple, spelling.variants(frame, **options).collect()))


@pytest.fixture(scope="module")
def varied():
    """Chains of forms, ties, letters beyond ASCII, anagrams, one very frequent word."""
    out = [(i, "Receive RECEIVE " * 40 + "recieve receeve receiv") for i in range(8)]
    out += [(i, "colour " * 30 + "color colors colur") for i in range(20, 30)]
    out += [(i, "straße strasse straßen übungün ubungun ×÷×÷×÷") for i in range(40, 46)]
    out += [(50 + i, "abcdef " * 150 + "abcdeg " * 30 + "abcdfg " * 6 + "bacdef " * 5) for i in range(1)]
    out += [(60, "tieaaa " * 25 + "tiebbb " * 25 + "tieaab " * 5 + "tiebba " * 5 + "tieabb " * 5)]
    return out


@pytest.mark.parametrize("groups", [None, 1, 3, 7])
def test_equals_all_pairs(spark, varied, groups):
    assert of(spark, varied, groups=groups) == judged(counted(varied))


def test_chain_of_forms_is_followed_to_its_end(spark):
    rows = [(1, " ".join(w for w, n in (("aaaaaaaa", 3125), ("aaaaaaab", 625), ("aaaaaabb", 125), ("aaaaabbb", 25), ("aaaabbbb", 5)) for _ in range(n)))]
    got = of(spark, rows)
    assert got == judged(counted(rows))
    assert {r[2] for r in got} == {"aaaaaaaa"}


def test_given_table(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert set(map(tuple, spelling.variants(docs).collect())) == judged(counted(rows))


def test_parts_of_a_block_meet_each_other(spark):
    words = [f"{a}{b}{c}xyz" for a in "abcd" for b in "efgh" for c in "ijkl"]
    frame = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    got = Counter((r.word, r.near) for r in spelling.near_words(frame, 1, rows=5).collect())
    assert got == Counter((a, b) for a in words for b in words if a != b and one_edit(a, b))


def test_runs_are_counted_alike_in_small_slices(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.word: r.n for r in spelling.word_counts(docs, size=900).collect() if r.n >= 5}
    assert got == counted(rows)


@given(st.lists(st.text("abcé", min_size=4, max_size=4), min_size=1, max_size=12), st.lists(st.text("abcé", min_size=5, max_size=5), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_near_pairs(short, long):
    a, b = (spelling._matrix(w) for w in (short, long))
    for left, right, x, y in ((a, a, short, short), (a, b, short, long)):
        got = set(zip(*(v.tolist() for v in spelling.near_pairs(left, right))))
        assert got == {(i, j) for i, v in enumerate(x) for j, w in enumerate(y) if one_edit(v, w)}


def test_long_words():
    words = ["ab" * 3000, "ab" * 2999 + "ac", "ba" * 3000]
    i, j = spelling.near_pairs(spelling._matrix(words), spelling._matrix(words))
    assert set(zip(i.tolist(), j.tolist())) == {(0, 1), (1, 0)}


def test_crc_of_prefix_and_run():
    lengths = np.array([0, 1, 6, 300])
    shifts = spelling._prefix_shift(b"12345:", lengths.tolist())
    for n, shift in zip(lengths, shifts):
        run = bytes(range(97, 123)) * 12
        assert zlib.crc32(b"12345:" + run[:n]) == zlib.crc32(run[:n]) ^ int(shift)


def test_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()] * 6
    frame = odd
    for _ in range(5):
        frame = frame.unionByName(odd)
    assert set(map(tuple, spelling.variants(frame).collect())) == judged(counted(rows))


def test_empty_table(spark, none):
    assert spelling.variants(none).collect() == []
    assert spelling.variants(none.withColumn("word", F.lit("x"))).columns == ["word", "form", "root", "n", "n_near", "form_n"]
