from __future__ import annotations

import os
import sys
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))

import corpus_pipeline as pipeline  # noqa: E402
from ledgerline.llm import langid, packing, quality  # noqa: E402

COLUMNS = list(pipeline.COLUMNS)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["language ID", "quality rules", "SimHash near-dedup", "substring dedup", "packing"]


def test_run_equals_brute_force(spark, small, docs, plain):
    kept = plain
    seen = {r.doc_id: r for r in langid.identify(docs).collect()}
    kept = [r for r in kept if seen[r[0]].lang_pred != langid.UNKNOWN and seen[r[0]].score >= pipeline.LEAST_SCORE]
    left = spark.createDataFrame(kept, docs.schema)
    assert rows_of(pipeline.language(spark, docs, small)) == sorted(kept)

    # with few labels no cutoff can be shown safe, so the base alone decides here
    assert {r.symbols_per_word for r in quality.cutoffs(quality.metrics(left), spark.read.parquet(f"{small}/labels.parquet")).collect()} <= {None}
    found = {r[0]: brute.quality_metrics(r[1]) for r in kept}
    kept = [r for r in kept if found[r[0]][0] >= 50 and 100 * found[r[0]][4] <= 50 * found[r[0]][0]]
    assert rows_of(pipeline.clean(spark, left, small)) == sorted(kept)

    groups = brute.near_duplicates(kept)
    kept = [r for r in kept if groups[r[0]][1] == r[0]]
    left = spark.createDataFrame(kept, docs.schema)
    cut = brute.without_repeats(kept)
    texts = {r[0]: " ".join(cut[r[0]][2]) if cut[r[0]][1] else r[1] for r in kept if cut[r[0]][2]}
    got = pipeline.without_repeats(spark, left, small)
    assert got.columns == COLUMNS
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {
        r[0]: (texts[r[0]], len(texts[r[0]]) if cut[r[0]][1] else r[4]) for r in kept if r[0] in texts
    }

    tokenizer = Tokenizer.from_file(pipeline.tokenizer_path())
    want = []
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4")
        at = 0
        for length in packing.binary_lengths(len(ids), 4096):
            want.append((doc, at, length, len(ids), ids[at : at + length].tobytes()))
            at += length
    rows = pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in rows) == sorted(want)


@pytest.mark.parametrize("k", range(4))
def test_stages_take_odd_rows_and_keep_the_columns(spark, small, odd, k):
    """Null, empty, letterless and very long texts, a repeated row and a row without id: exactly those that the stage's rule keeps."""
    got = pipeline.STAGES[k][1](spark, odd.select(*COLUMNS, "n_words", "score", "key"), small)
    assert got.columns == COLUMNS
    ids = Counter(r.doc_id for r in got.collect())
    if k == 0:  # of all texts with letters, those with a clear language
        seen = langid.predict(odd.select(*COLUMNS), langid.fit(odd.select(*COLUMNS))).collect()
        want = Counter(r.doc_id for r in seen if r.lang_pred != langid.UNKNOWN and r.score >= pipeline.LEAST_SCORE)
        assert ids == want and not {1, 2, 3, 5} & set(ids)
    elif k == 1:  # fifty words and more, less than half of them in repeated windows: none here
        assert ids == Counter()
    elif k == 2:  # texts without words share the zero fingerprint; the copies and the repeated row leave one each
        assert ids == Counter({1: 1, 4: 1, 5: 1, 6: 1, 8: 1, None: 1})
    else:  # a copy loses all its words and goes, as do texts without words
        assert ids == Counter({4: 1, 5: 1, 6: 1, 8: 2, None: 1})
        by_id = {r.doc_id: r for r in got.collect()}
        assert by_id[6].text.split()[:3] == ["w0x0", "w1x1", "w2x2"] and by_id[4].text == "one"


@pytest.mark.parametrize("k", range(5))
def test_stages_take_an_empty_table(spark, small, none, k):
    assert pipeline.STAGES[k][1](spark, none, small).count() == 0


def test_clean_documents_stay(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    known = pipeline.language(spark, docs, sf_dir)
    assert known.join(good, "doc_id").count() == docs.join(good, "doc_id").count()
    long_enough = known.join(good, "doc_id").filter(F.size(F.split("text", "\\s+")) > 60)
    left = pipeline.clean(spark, known, sf_dir).join(long_enough.select("doc_id"), "doc_id").count()
    assert left >= 0.98 * long_enough.count()


def test_rows_without_id_and_rows_that_repeat_one(spark, small, docs):
    long = [r.text for r in docs.orderBy("doc_id").collect() if len(r.text.split()) > 120]
    tried = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(long[:40])], docs.schema)
    tried = pipeline.distinct(spark, pipeline.clean(spark, tried, small), small)
    texts = [r.text for r in tried.orderBy("doc_id").limit(3).collect()]
    bad = "spam " * 200
    rows = [
        (None, texts[0], "en", "a", 1), (None, texts[0], "en", "a", 1), (5, texts[1], "en", "a", 1), (5, texts[1], "en", "a", 1),
        (5, bad, "en", "a", 1), (None, bad, "en", "a", 1), (6, texts[1], "en", "a", 1), (None, texts[1], "en", "a", 1), (5, texts[2], "en", "a", 1),
    ]
    left = pipeline.clean(spark, spark.createDataFrame(rows, docs.schema), small)
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted((r[0] or 0, r[1]) for r in rows if r[1] != bad)
    one = pipeline.distinct(spark, left, small)
    assert sorted((r.doc_id or 0, r.text) for r in one.collect()) == sorted([(0, texts[0]), (5, texts[1]), (5, texts[2])])
