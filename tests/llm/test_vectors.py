from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, seed=0, n=400, dense=120):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, 16))
    rows[:dense] = rows[0] + 0.05 * rng.normal(size=(dense, 16))
    for i in range(dense, dense + 60, 2):
        rows[i + 1] = 3 * rows[i] + 0.1 * rng.normal(size=16)
    rows[-20:] = rows[-1]
    rows = rows.astype(np.float32)
    return rows, spark.createDataFrame([(i, [float(x) for x in r], 0) for i, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("block", [vectors.BLOCK, 16])
def test_against_all_pairs(spark, block):
    rows, df = table(spark)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    want = linked.sum(1) - 1
    got = {r.vec_id: r for r in vectors.near_duplicates(df, block=block).collect()}
    assert [got[i].n_links for i in range(len(rows))] == want.tolist()
    groups = brute.grouped(list(range(len(rows))), lambda a, b: linked[a, b])
    assert all(got[i].component_id == groups[i] for i in groups)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_links_planted_in_the_given_table(spark):
    """The given vectors hold no pair at 0.9, so copies and near copies of some of them are added."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = np.array([r.embedding for r in given], np.float32)
    rng = np.random.default_rng(2)
    near = rows[::7] + 0.04 * np.linalg.norm(rows[::7], axis=1, keepdims=True) * rng.normal(size=rows[::7].shape)
    rows = np.concatenate([rows, 2 * rows[::11], near, np.repeat(rows[5:6], 300, axis=0) + 0.01 * rng.normal(size=(300, rows.shape[1]))]).astype(np.float32)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(1) for i in range(0, len(unit), 1000)]) - 1
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(rows)), "embedding": list(rows)}))
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    assert want.sum() > 90_000 and [got[i] for i in range(len(rows))] == want.tolist()


def test_links_are_symmetric_sums(spark):
    _, df = table(spark, seed=5)
    got = vectors.near_duplicates(df, probes=2).collect()
    assert sum(r.n_links for r in got) % 2 == 0


def test_invalid_vectors_link_with_nothing(spark):
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0),
        (6, [float("nan"), 1.0], 0), (7, [float("inf"), 1.0], 0), (8, [], 0), (9, [1.0, 0.0, 0.0], 0), (10, [1.0, 0.0], None),
        (11, [1e30, 1e30], 0), (12, [1e-30, 1e-30], 0),
    ]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[10] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert got[11] == (1, 11, True) and got[12] == (1, 11, False)


def test_repeated_and_missing_ids_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], "x", 3), (1, [1.0, 0.0], "x", 3), (None, [1.0, 0.0], "x", 3), (2, [0.0, 1.0], "x", 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string, n long")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect())
    assert got == [(0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("rows", [[], [(1, None, 0)]])
def test_empty_tables(spark, rows):
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [(i, 0, i, True) for i, _, _ in rows]


def test_every_link_of_a_hot_group_is_found(spark):
    """A third of the vectors lie close together and fall into far more lists than a few probes reach."""
    rng = np.random.default_rng(11)
    rows = rng.normal(size=(12_000, 32))
    rows[::3] = rows[0] + 0.2 * rng.normal(size=(4_000, 32))
    rows = rows.astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(rows)), "embedding": list(rows)}))
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(1) for i in range(0, len(unit), 1000)]) - 1
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).select("vec_id", "n_links").collect()}
    assert want.sum() > 10_000_000 and [got[i] for i in range(len(rows))] == want.tolist()


def test_vectors_unlike_the_sample_keep_their_links(spark):
    rng = np.random.default_rng(4)
    rows = 1 + 0.02 * rng.normal(size=(400, 16))
    rows[:40] = np.repeat(rng.normal(size=(20, 16)), 2, axis=0) + 0.1 * rng.normal(size=(40, 16))
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(rows)), "embedding": list(rows)}))
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, sample=64).collect()}
    assert want[:40].sum() >= 30 and [got[i] for i in range(len(rows))] == want.tolist()


def test_rows_without_id_and_shared_ids_are_nodes_of_their_own(spark):
    near = [(i, [1.0, 0.01 * i, 0.0], 0) for i in range(1, 9)]
    bare = [(None, [1.0, 0.003 + 0.01 * i, 0.0], 0) for i in range(8)]
    rows = [*near, *bare, (20, [0.0, 1.0, 0.0], 0), (20, [0.0, 0.0, 1.0], 0), (21, [0.0, 0.01, 1.0], 0)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {(r.component_id, r.n_links) for r in got if (r.vec_id or 0) < 20} == {(1, 15)}
    assert [r.vec_id for r in got if r.kept and (r.vec_id or 0) < 20] == [1]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if (r.vec_id or 0) >= 20) == [(20, 0, 20), (20, 1, 20), (21, 1, 20)]
