from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe
from ledgerline.llm.catalog import tokenizer_path
from ledgerline.llm.tokens import WordEncoder

with open(tokenizer_path(), encoding="utf-8") as file:
    ENCODER = WordEncoder(file.read(), remember=50)


def library(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def own(texts):
    ids, ends = ENCODER.encode_column(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


PART = st.one_of(
    st.text(max_size=6),
    st.sampled_from(["don't", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "Σ", "ΟΔΟΣ", "İ", "ﬁ", "é", "\x1c", "\x85", "²"]),
    st.characters(max_codepoint=0x3FF),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PART, max_size=8).map(" ".join) | st.none() | st.lists(PART, max_size=5).map("".join), max_size=5))
def test_ids_are_the_librarys(texts):
    assert own(texts) == [library(t) for t in texts]


def test_all_white_space():
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace() or c in (0x180E, 0x200B, 0xFEFF)]
    assert own([f"a{s}b" for s in spaces]) == [library(f"a{s}b") for s in spaces]


def expected(rows):
    out = {}
    for doc, text in rows:
        ids = library(text)
        decoded = ENCODER.tokenizer.decode(ids, skip_special_tokens=False)
        out[doc] = (len(ids), __import__("hashlib").sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(decoded))
    return out


def test_small_table(docs, plain):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, tokenizer_path()).collect()}
    assert got == expected([r[:2] for r in plain])


def test_batches_and_buckets(docs, plain, monkeypatch):
    monkeypatch.setattr(bpe, "DOCS_PER_BATCH", 7)
    got = bpe.round_trip(docs, tokenizer_path(), buckets=3, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {r[0]: library(r[1]) for r in plain}
    assert all(r.decoded == ENCODER.tokenizer.decode(r.ids, skip_special_tokens=False) for r in got)


def test_rows_in_another_order_at_each_read(docs, plain, monkeypatch):
    """As after a shuffle or a repeated task: batches are made once, so words and documents still belong together."""

    def shuffled(batches):
        import os
        import random

        for batch in batches:
            order = list(range(batch.num_rows))
            random.Random(os.urandom(8)).shuffle(order)
            yield batch.take(pa.array(order))

    monkeypatch.setattr(bpe, "DOCS_PER_BATCH", 7)
    loose = docs.select("doc_id", "text").mapInArrow(shuffled, "doc_id long, text string")
    frame = bpe.round_trip(loose, tokenizer_path(), buckets=5)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in frame.collect()}
    assert got == expected([r[:2] for r in plain])
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(odd):
    got = bpe.round_trip(odd, tokenizer_path()).collect()
    assert len(got) == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected(rows)


def test_empty_table(none):
    assert bpe.round_trip(none, tokenizer_path()).collect() == []


@pytest.mark.parametrize("text", [None, "", " "])
def test_only_empty_texts(spark, text):
    got = bpe.round_trip(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), tokenizer_path()).collect()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got] == [(0, brute.sha(""), brute.sha(""))] * 2
