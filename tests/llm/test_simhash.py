from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from ledgerline.llm import simhash

TABLES = simhash.golay_tables()


def test_golay_code_is_perfect():
    remainders, errors = TABLES
    codewords = (np.arange(1 << 12, dtype=np.uint32) << np.uint32(11)) | remainders
    weights = np.bitwise_count(codewords)
    assert sorted(set(weights.tolist())) == [0, 7, 8, 11, 12, 15, 16, 23]
    assert len(set(errors.tolist())) == 1 << 11 and np.bitwise_count(errors).max() == 3


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_close_fingerprints_share_a_key(bits):
    rng = np.random.default_rng(bits)
    for value in rng.integers(0, 1 << 64, 300, dtype=np.uint64):
        other = value
        for bit in rng.choice(64, bits, replace=False):
            other ^= np.uint64(1) << np.uint64(bit)
        keys, rows = simhash.keys_of(np.array([value, other]), TABLES)
        assert set(keys[rows == 0]) & set(keys[rows == 1])
        assert len(set(keys[rows == 0])) == (rows == 0).sum() <= 69


def test_fingerprints(docs, plain):
    got = {r.doc_id: r.print & (1 << 64) - 1 for r in simhash.prints_of(docs).collect()}
    assert got == {r[0]: brute.fingerprint(r[1]) for r in plain}


def test_near_duplicates(docs, plain):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(plain)


@pytest.mark.parametrize("most", [1 << 16, 100, 4])
def test_dense_groups_and_large_keys(spark, most):
    rng = random.Random(most)
    values = {rng.getrandbits(64) for _ in range(100)}
    for centre in list(values)[:3]:
        for _ in range(150):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    rows = spark.createDataFrame([(v,) for v in values], "print long")
    links = [(r.a, r.b) for r in simhash.links_of(rows, most=most).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in links)
    want = brute.grouped(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    linked = {frozenset(x) for x in links}
    assert brute.grouped(values, lambda a, b: frozenset((a, b)) in linked) == want
    if most > 1000:
        assert len(links) < 20 * len(values)


def test_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[3].fingerprint == "0" * 16
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[7].component_id == 6 and by_id[8].component_id == 8 and by_id[None].component_id is None


def test_empty_table(none):
    assert simhash.near_duplicates(none).collect() == []
