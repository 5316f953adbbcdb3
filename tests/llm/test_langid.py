from __future__ import annotations

import zlib

import numpy as np
import pytest

from ledgerline.llm import langid


def grams(text, bits):
    codes = [ord(c) for c in f" {text.lower()} "]
    for order in langid.ORDERS:
        for i in range(len(codes) - order + 1):
            h = order
            for c in codes[i : i + order]:
                h = (h ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                h ^= h >> 15
            yield h >> 32 - bits


@pytest.mark.parametrize("chunk", [langid.CHUNK, 16])
def test_scores_equal_plain_sums(chunk, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    weights = np.random.default_rng(0).normal(size=(1 << 10, 3)).astype(np.float32)
    texts = ["", "a", "Ärger über 日本", "x" * 100, "one two", "é"]
    want = [sum((weights[g].astype(float) for g in grams(t, 10)), np.zeros(3)) for t in texts]
    assert np.allclose(langid.score_texts(texts, weights, 10), want, atol=1e-4)
    counts = np.bincount([g for t in texts for g in grams(t, 10)], minlength=1 << 10)
    assert (langid.count_grams(texts, 10) == counts).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got}
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "wort und satz", "zz" if i in ids else "de") for i in range(50)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} == {"de"}


def test_bounded_sample(spark):
    rows = [(i, "the cat" if i % 2 else "le chat", "en" if i % 2 else "fr") for i in range(2000)]
    labels, weights, prior = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows_per_lang=100)
    assert labels == ["en", "fr"] and weights.shape == (1 << 15, 2) and abs(np.exp(prior).sum() - 1) < 1e-9


def test_odd_rows(odd):
    got = langid.identify(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].lang_pred, by_id[i].score) == (langid.UNKNOWN, 0.0) for i in (1, 2, 3, 5))
    assert by_id[6].lang_pred == by_id[7].lang_pred and by_id[6].score == by_id[7].score
    assert by_id[None].held_out is False


def test_nothing_to_learn_from(none, odd):
    assert langid.identify(none).collect() == []
    got = langid.predict(odd, langid.fit(none)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {(langid.UNKNOWN, 0.0)}
