from __future__ import annotations

from collections import Counter
from math import log

import numpy as np
import pytest

from ledgerline.llm import lm


def test_prefers_texts_like_the_target(spark):
    rows = [(i, ("sun moon star " if i % 2 else "tax law code ") * 20) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = spark.createDataFrame([(i,) for i in range(1, 30, 2)], "doc_id long")
    got = lm.cross_entropy_difference(df, wanted).collect()
    assert all(r.selected == (r.doc_id % 2 == 1) for r in got)


def test_odd_rows(odd, spark):
    wanted = spark.createDataFrame([(6,), (None,)], "doc_id long")
    got = lm.cross_entropy_difference(odd, wanted).collect()
    assert len(got) == odd.count()
    null = next(r for r in got if r.doc_id == 1)
    assert (null.n_tokens, null.target_loss, null.score, null.selected) == (0, None, 0.0, False)
    assert all(np.isfinite(r.score) for r in got)


def test_empty_tables(none, odd):
    ids = none.select("doc_id")
    assert lm.cross_entropy_difference(none, ids).collect() == []
    assert lm.cross_entropy_difference(odd, ids).count() == odd.count()


@pytest.mark.parametrize(("chunk", "buckets"), [(12 << 20, None), (9_000, None), (9_000, 1), (9_000, 40)])
def test_every_word_and_pair_counts(spark, monkeypatch, chunk, buckets):
    """Many distinct words and pairs, over several chunks and buckets."""
    monkeypatch.setattr(lm, "CHUNK", chunk)
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 60_000, 400) ** 2 // 30_000)) for i in range(300)]
    rows += [(300 + i, text) for i, (_, text) in enumerate(rows[:5])] + [(400, ""), (401, None)]
    good = set(range(0, 300, 4))

    def counts(docs):
        one, two = Counter(), Counter()
        for words in docs:
            one.update(words)
            two.update(zip(words, words[1:]))
        return one, two

    texts = {doc: (text or "").split() for doc, text in rows}
    every, wanted = counts(texts.values()), counts(texts[d] for d in good)
    size = len(every[0]) + 1

    def loss(words, model, own):
        n, out = sum(model[0].values()) - sum(own[0].values()), 0.0
        for i, w in enumerate(words):
            p = (model[0][w] - own[0][w] + 1) / (n + size)
            if i and (before := model[0][words[i - 1]] - own[0][words[i - 1]]) > 0:
                at = words[i - 1], w
                pair = min(model[1][at] - own[1][at], before, model[0][w] - own[0][w])
                p = lm.BIGRAM_WEIGHT * pair / before + (1 - lm.BIGRAM_WEIGHT) * p
            out -= log(p)
        return out / len(words)

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = lm.cross_entropy_difference(df, spark.createDataFrame([(d,) for d in good], "doc_id long"), buckets=buckets).collect()
    assert size > 32_000 and sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        words = texts[r.doc_id]
        assert r.n_tokens == len(words)
        if words and r.doc_id % 7 == 0:
            own = counts([words])
            assert r.background_loss == pytest.approx(loss(words, every, own))
            assert r.target_loss == pytest.approx(loss(words, wanted, own if r.doc_id in good else (Counter(), Counter())))


def test_packed_numbers_come_back():
    for kind, values in (("<u8", [0, 1, 2**63, 5]), ("<i4", []), ("<u2", [7, 65_535])):
        numbers = np.array(values, kind)
        assert (lm._unpacked(lm._packed(numbers, kind), kind) == numbers).all()


def test_lists_hold_every_entry_once():
    words = [f"w{i}".encode() for i in range(500)]
    ids = np.random.default_rng(1).integers(0, 500, 4000)
    grams = lm._Grams(
        np.array([True, False]).tobytes(), lm._packed(np.array([1500, 2500]), "<i4"), lm._packed(ids, "<i4"), lm._squeezed(b" ".join(words))
    )
    places = np.concatenate([part for _, part in grams.lists(7)])
    assert sorted(places.tolist()) == list(range(len(grams.n)))
    assert grams.n[:500].sum() == 4000 and grams.n[500:].sum() == 3998 and grams.g[:500].sum() == 1500
    for _, part in grams.lists(7):
        assert (np.diff(grams.key[part].astype(object)) >= 0).all()
