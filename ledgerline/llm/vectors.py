"""Embedding near-duplicates by product quantisation.

Vectors of unit length fall into the inverted list of their nearest coarse
centroid and are stored as codes of their residual, one per subspace. A query
visits every list that can hold a neighbour, adds up table-looked-up distances
to the codes there, and compares the survivors exactly by cosine. Every vector
is indexed and is a query; a pair is compared in one place only, the higher of
its two lists. Lists travel together in blocks, so a vector is copied once for
each block it visits and not once for each list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerline.llm.common import batch_of, components, pieces, staged

#: Vectors the index is fitted on, at most; chosen by a hash of the id.
SAMPLE = 16_384
#: Vectors per inverted list aimed at, and the largest number of lists.
PER_LIST, MOST_LISTS = 128, 2_048
SUBSPACES = 8
#: Members and queries that are compared at once, and rows of a block on small tables.
BLOCK = 2_048
#: Blocks aimed at on large tables, which then have more rows each, up to BLOCK_BYTES in double precision; beyond, blocks grow in number.
MOST_BLOCKS = 64
BLOCK_BYTES = 32 << 20


@dataclass
class Index:
    """Coarse centroids (lists x dim) and codebooks (subspace x code x width)."""

    centroids: np.ndarray
    books: list[np.ndarray]
    cuts: list[tuple[int, int]]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def k_means(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows; an empty centre stays where it was."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([squared(rows[i : i + 1024], centres).argmin(1) for i in range(0, len(rows), 1024)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        sizes = np.bincount(nearest, minlength=k)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit(sample: np.ndarray, n: int, subspaces: int = SUBSPACES) -> Index:
    """An index for ``n`` vectors from a sample of them (unit rows)."""
    lists = int(np.clip(n // PER_LIST, 1, min(MOST_LISTS, len(sample))))
    centroids = k_means(sample, lists)
    own = np.concatenate([squared(sample[i : i + 1024], centroids).argmin(1) for i in range(0, len(sample), 1024)])
    residual = sample - centroids[own]
    bounds = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
    cuts = [(int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:])]
    books = [k_means(residual[:, a:b], min(256, len(sample))) for a, b in cuts]
    return Index(centroids, books, cuts)


def encode(index: Index, residual: np.ndarray) -> np.ndarray:
    columns = [squared(residual[:, a:b], book).argmin(1) for (a, b), book in zip(index.cuts, index.books)]
    return np.stack(columns, axis=1).astype(np.uint8)


def decode(index: Index, codes: np.ndarray) -> np.ndarray:
    return np.concatenate([book[codes[:, m]] for m, book in enumerate(index.books)], axis=1)


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision from the components' bytes."""
    rows = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def reach_of(threshold: float) -> float:
    """The largest distance of linked unit vectors, with room for rounding."""
    return float(np.sqrt(max(2 - 2 * threshold, 0.0))) + 1e-6


def may_hold(rows: np.ndarray, index: Index, own: np.ndarray, reach: float, probes: int | None = None) -> np.ndarray:
    """Which lists, from its own onwards, can hold a vector within ``reach`` of each row (rows x lists).

    A vector in list c is no farther from centroid c than from the row's own
    centroid. So c holds none within ``reach`` if the plane halfway between the
    two centroids is farther from the row than that.
    """
    far = squared(rows, index.centroids)
    number, which = np.unique(own, return_inverse=True)
    apart = np.sqrt(squared(index.centroids[number], index.centroids))[which]
    near = far - far[np.arange(len(own)), own][:, None] <= 2 * reach * apart + 1e-9
    near &= np.arange(len(index.centroids)) >= own[:, None]
    if probes is not None and probes < near.shape[1]:
        near &= np.argsort(np.argsort(np.where(near, far, np.inf), axis=1, kind="stable"), axis=1) < probes
    return near


def blocks_of(sizes: dict[int, int], lists: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each list: neighbours share one of up to ``rows`` vectors, larger lists are split."""
    first, parts = np.zeros(lists, np.int64), np.zeros(lists, np.int64)
    at, held = 0, 0
    for number, size in sorted(sizes.items()):
        parts[number] = -(-size // rows)
        if held and held + size > rows:
            at, held = at + 1, 0
        first[number], held = at, held + size
        if parts[number] > 1:
            at, held = at + int(parts[number]), 0
    return first, parts


def _valid(df: DataFrame, id_col: str, vec_col: str, kind: str) -> DataFrame:
    """(vec_id, raw) of every row: components as bytes of type ``kind``, null for a vector that links with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("raw", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            ids, raw = [], []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vec").to_pylist()):
                row = np.array(vector if vector and None not in vector else [0], kind)
                ids.append(vec_id)
                raw.append(row.tobytes() if np.isfinite(row).all() and row.any() else None)
            yield batch_of(schema, ids, raw)

    source = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    return source.mapInArrow(made, "vec_id long, raw binary")


_PLACED = pa.schema(
    [("node", pa.int64()), ("n", pa.int64()), ("raw", pa.binary()), ("list", pa.int64()), ("codes", pa.binary()), ("lost", pa.float64())]
)
_PLACED_TYPES = "node long, n long, raw binary, list long, codes binary, lost double"
_SENT = pa.schema([*_PLACED, ("block", pa.int64()), ("visits", pa.list_(pa.int64()))])


def _placed(batches: Iterator[pa.RecordBatch], shared, kind: str) -> Iterator[pa.RecordBatch]:
    """List and codes of each vector, and what coding loses of it."""
    index: Index = Index(**shared.value)
    for batch in pieces(batches, 1024):
        if not batch.num_rows:
            continue
        rows = unit_rows(batch.column("raw").to_pylist(), kind)
        own = squared(rows, index.centroids).argmin(1)
        residual = rows - index.centroids[own]
        codes = encode(index, residual)
        lost = np.linalg.norm(residual - decode(index, codes), axis=1)
        yield batch_of(_PLACED, batch.column("node"), batch.column("n"), batch.column("raw"), own, [c.tobytes() for c in codes], lost)


def _sent(batches: Iterator[pa.RecordBatch], shared, first, parts, reach: float, probes: int | None, kind: str) -> Iterator[pa.RecordBatch]:
    """Own block of each vector and the blocks of the lists it visits."""
    index: Index = Index(**shared.value)
    used = np.flatnonzero(parts)
    spans = [np.arange(first[i], first[i] + parts[i]) for i in used]
    number, block = np.repeat(used, parts[used]), np.concatenate(spans)
    # blocks ascend with lists: each block's lists stand together
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for batch in pieces(batches, 1024):
        if not batch.num_rows:
            continue
        own = batch.column("list").to_numpy()
        near = may_hold(unit_rows(batch.column("raw").to_pylist(), kind), index, own, reach, probes)
        some = np.logical_or.reduceat(near[:, number], starts, axis=1)
        mixed = (batch.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        at = first[own] + mixed.astype(np.int64) % parts[own]
        yield batch_of(_SENT, *[batch.column(c) for c in _PLACED.names], at, [block[starts[x]].tolist() for x in some])


class Forest:
    """Few of the links that connect what all links of places 0 to ``n`` - 1 connect."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.a: list[int] = []
        self.b: list[int] = []

    def _top(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            apart = self.root[x] != self.root[y]
            x, y = x[apart], y[apart]
            if not len(x):
                return
            # one link of each tree that has any, so each round at least halves their number
            first = np.full(len(self.root), -1)
            first[self.root[x]] = np.arange(len(x))
            for i in first[first >= 0].tolist():
                rx, ry = self._top(x[i]), self._top(y[i])
                if rx != ry:
                    self.root[rx] = ry
                    self.a.append(int(x[i]))
                    self.b.append(int(y[i]))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _tables(q: np.ndarray, index: Index) -> np.ndarray:
    """Products of every code with each query: what the distances to all lists are looked up in (codes x queries)."""
    return np.concatenate([book @ q[:, a:b].T for (a, b), book in zip(index.cuts, index.books)], axis=0).astype(np.float32)


def _member_terms(codes: np.ndarray, lists: np.ndarray, index: Index) -> np.ndarray:
    """Per member the part of a coded distance that no query changes: its decoded residual's square and product with the centroid."""
    residual = decode(index, codes)
    return np.einsum("ij,ij->i", residual, residual) + 2 * np.einsum("ij,ij->i", residual, index.centroids[lists])


def _linked(
    q: np.ndarray, m: np.ndarray, tables: np.ndarray, base: np.ndarray, places: np.ndarray, terms: np.ndarray, bound: np.ndarray,
    asking: np.ndarray, threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``asking`` queries and the members of one list that link.

    The squared distance of query and coded member is |q - c|^2 (``base``) plus the
    member's term less twice the product of q and the decoded residual, which is
    looked up in ``tables``, whole rows of them, at ``places``. It is off by no more
    than what coding loses of the member, which ``bound`` allows for.
    """
    if 4 * len(asking) < len(q):
        tables, base, back = np.ascontiguousarray(tables[:, asking]), base[asking], asking
    else:
        back, skipped = np.arange(len(q)), np.ones(len(q), bool)
        skipped[asking] = False
        base = np.where(skipped, np.inf, base)
    near = tables[places[:, 0]]
    for s in range(1, places.shape[1]):
        near += tables[places[:, s]]
    # far <= bound, solved for the product
    least = ((base[None, :] + terms[:, None]) - bound[:, None] - 1e-5) / 2
    right, left = np.nonzero(near >= least.astype(np.float32))
    left = back[left]
    if 8 * len(left) > near.size:
        good = (q @ m.T)[left, right] >= threshold
    else:
        good = np.empty(len(left), bool)
        for at in range(0, len(left), 65_536):
            some = slice(at, at + 65_536)
            good[some] = np.einsum("ij,ij->i", q[left[some]], m[right[some]]) >= threshold
    return left[good], right[good]


def _compared(queries: pa.Table, members: pa.Table, shared, threshold: float, probes: int | None, kind: str) -> pa.Table:
    """Links of one block of queries with one block of members.

    Rows with b give links that connect the blocks' groups; rows without b
    give how many vectors ``a`` is linked to here.
    """
    index: Index = Index(**shared.value)
    if not queries.num_rows or not members.num_rows:
        return pa.Table.from_batches([], _FOUND)
    members = members.sort_by("list")
    q, m = unit_rows(queries.column("raw").to_pylist(), kind), unit_rows(members.column("raw").to_pylist(), kind)
    codes = np.frombuffer(b"".join(members.column("codes").to_pylist()), np.uint8).reshape(members.num_rows, -1)
    bound = (reach_of(threshold) + members.column("lost").to_numpy()) ** 2 * (1 + 1e-5)
    widths = np.array([len(book) for book in index.books])
    places = codes.astype(np.int64) + (np.cumsum(widths) - widths)[None, :]
    q_list, m_list = queries.column("list").to_numpy(), members.column("list").to_numpy()
    q_node, m_node = queries.column("node").to_numpy(), members.column("node").to_numpy()
    q_n, m_n = queries.column("n").to_numpy(), members.column("n").to_numpy()
    q_links, m_links = np.zeros(len(q), np.int64), np.zeros(len(m), np.int64)
    nodes, place = np.unique(np.concatenate([q_node, m_node]), return_inverse=True)
    q_place, m_place, forest = place[: len(q)], place[len(q) :], Forest(len(nodes))
    ends = np.flatnonzero(np.diff(m_list, append=-1)) + 1
    terms = _member_terms(codes, m_list, index)
    for at in range(0, len(q), BLOCK):
        some = slice(at, at + BLOCK)
        near = may_hold(q[some], index, q_list[some], reach_of(threshold), probes)
        tables, base = _tables(q[some], index), squared(q[some], index.centroids)
        start = 0
        for end in ends.tolist():
            here = int(m_list[start])
            asking = np.flatnonzero(near[:, here])
            for low in range(start, end, BLOCK) if len(asking) else ():
                held = slice(low, min(low + BLOCK, end))
                left, right = _linked(
                    q[some], m[held], tables, base[:, here], places[held], terms[held], bound[held], asking, threshold
                )
                left, right = at + left, low + right
                # members of one list meet twice; they are compared where the smaller node is the query
                keep = (q_list[left] != here) | (q_node[left] < m_node[right])
                left, right = left[keep], right[keep]
                q_links += np.bincount(left, weights=m_n[right], minlength=len(q)).astype(np.int64)
                m_links += np.bincount(right, weights=q_n[left], minlength=len(m)).astype(np.int64)
                forest.add(q_place[left], m_place[right])
            start = end
    some_q, some_m = np.flatnonzero(q_links), np.flatnonzero(m_links)
    none = [None] * (len(some_q) + len(some_m))
    return pa.Table.from_batches(
        [
            batch_of(
                _FOUND,
                nodes[forest.a].tolist() + q_node[some_q].tolist() + m_node[some_m].tolist() if forest.a else [],
                nodes[forest.b].tolist() + none if forest.a else [],
                [0] * len(forest.a) + q_links[some_q].tolist() + m_links[some_m].tolist() if forest.a else [],
            )
        ]
    )


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    probes: int | None = None,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``.

    Two vectors link if their cosine is at least ``threshold``; a vector visits
    every list that can hold such a one. Lists are fitted on at most about
    ``sample`` vectors, all vectors are indexed and searched. ``probes`` limits
    the lists a vector visits, for a quicker search that misses links. Equal vectors are one
    member with a weight. Blocks of vectors are compared in tasks of their own,
    so a list that holds a third of all vectors is shared by many tasks. Vectors of
    another length are indexed apart, one search per length. Vectors that are
    null, zero, or hold null or non-finite components have no links; so has a
    vector of another length with those of this one. Ids are whole numbers;
    rows with a null id are searched but never name a component, so one of
    such rows alone has no name and keeps them all. Rows that repeat an id
    with other components are vectors of their own.
    """
    # the components as they are; double precision starts from them in each task
    single = isinstance(df.schema[vec_col].dataType, ArrayType) and isinstance(df.schema[vec_col].dataType.elementType, FloatType)
    kind = "<f4" if single else "<f8"
    rows = staged(_valid(df, id_col, vec_col, kind), "vectors")
    valid = rows.filter("raw is not null")
    # nodes have names apart from ids: several vectors may share an id, or have none
    nodes = valid.groupBy("raw").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    nodes = staged(nodes.withColumn("node", F.xxhash64("raw")).withColumn("width", F.octet_length("raw")), "distinct-vectors")
    found = None
    for row in nodes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect():
        own = nodes.filter(F.col("width") == row["width"]).select("node", "n", "raw")
        some = _search(own, row["n"], threshold, probes, sample, block, kind)
        found = some if found is None else found.unionByName(some)
    alone = (F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.filter("raw is null").select("vec_id", *alone)
    if found is not None:
        found = staged(found, "vector-links")
        counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
        groups = components(found.filter("b is not null").select("a", "b"))
        result = nodes.join(counts, "node", "left").join(groups, "node", "left")
        result = result.withColumn("component", F.coalesce("component", "node"))
        names = result.groupBy("component").agg(F.min("first").alias("component_id"))
        result = result.join(names, "component").select(
            "raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
        )
        # stored, so that the join below meets two plain shuffles and a hot vector's rows can be split
        linked = valid.join(staged(result, "vector-groups"), "raw").select("vec_id", "n_links", "component_id")
        out = out.unionByName(linked)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _search(nodes: DataFrame, n: int, threshold: float, probes: int | None, sample: int, block: int, kind: str) -> DataFrame:
    """Links among distinct vectors of one length: see ``_compared``."""
    spark = nodes.sparkSession
    share = min(1.0, sample / max(n, 1))
    chance = F.pmod(F.xxhash64("node", F.lit("fit")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = nodes.filter(chance < share).orderBy("node").select("raw").collect() or nodes.select("raw").limit(1).collect()
    index = fit(unit_rows([bytes(r["raw"]) for r in rows], kind), n)
    shared = spark.sparkContext.broadcast(vars(index))
    reach = reach_of(threshold)
    placed = staged(nodes.mapInArrow(lambda b: _placed(b, shared, kind), _PLACED_TYPES), "index")
    # one small row per list
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = 8 * index.centroids.shape[1]
    first, parts = blocks_of(sizes, len(index.centroids), max(block, min(-(-n // MOST_BLOCKS), BLOCK_BYTES // wide)))
    sent = placed.mapInArrow(
        lambda b: _sent(b, shared, first, parts, reach, probes, kind), f"{_PLACED_TYPES}, block long, visits array<long>"
    )
    sent = staged(sent, "visits")
    queries = sent.select("node", "n", "raw", "list", F.col("block").alias("q"), F.explode("visits").alias("m"))
    # a row for each two blocks that meet
    meet = staged(queries.select("q", "m").distinct(), "blocks")
    members = sent.drop("visits").withColumnRenamed("block", "m").join(meet, "m")
    members = members.toDF(*members.columns)
    return (
        queries.groupBy("q", "m")
        .cogroup(members.groupBy("q", "m"))
        .applyInArrow(lambda left, right: _compared(left, right, shared, threshold, probes, kind), "a long, b long, links long")
    )
