from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.llm.catalog import tokenizer_path

TOKENIZER = Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12_345])
def test_binary_lengths(n):
    lengths = packing.binary_lengths(n, 4096)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 for x in lengths) and len([x for x in lengths if x < 4096]) == len({x for x in lengths if x < 4096})


def check(rows, texts, longest):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0) and r.length <= longest and r.length & (r.length - 1) == 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_length = Counter(r.length for r in rows)
    for length, n in by_length.items():
        numbers = sorted(r.sequence_id // longest.bit_length() for r in rows if r.length == length)
        assert numbers == list(range(n))


@pytest.mark.parametrize("longest", [4096, 64])
def test_small_table(docs, plain, longest):
    check(packing.pack(docs, tokenizer_path(), longest).collect(), {r[0]: r[1] for r in plain}, longest)


def test_with_ids(docs):
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_odd_rows(odd):
    rows = packing.pack(odd, tokenizer_path()).collect()
    null = [r for r in rows if r.doc_id == 1]
    assert [(r.start, r.length, r.doc_tokens) for r in null] == [(0, 1, 1)]
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sum(r.length for r in rows if r.doc_id == 8) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 8)


def test_empty_table(none):
    assert packing.pack(none, tokenizer_path()).collect() == []


def test_power_of_two_only(docs):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, tokenizer_path(), 1000)
