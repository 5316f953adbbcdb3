"""SimHash near-duplicates found through Golay-code keys.

A 64-bit fingerprint is cut into three segments of at most 23 bits. The
perfect binary Golay code puts every 23-bit word within 3 bits of exactly one
codeword, so a segment x has a home (the index of that codeword) and a set of
near indices K(x): the homes of x and of x with one bit flipped, six at most.
Segments that differ in one bit have each other's home among their near
indices; segments that differ in two bits share a near index.

Four differing bits over three segments leave one of two cases:
  * a segment is equal, and one of the other two differs in at most two bits:
    keys (segment i itself, a near index of segment j), for all i, j;
  * two segments differ in exactly one bit each: keys (near i, home j) and
    (home i, near j), for all pairs i < j.
So fingerprints within four bits always share a key, and rows that share one
are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, batch_of, components, pieces, staged, type_of

SEED = 42
WIDTHS = (22, 21, 21)
LIMIT = 4
#: Shingles counted at once, and rows of a key compared in one task.
BLOCK = 1 << 16
SHORT = 64
# Fixed value: generator polynomial of the binary Golay code of length 23.
GENERATOR = 0xAE3


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """Majority vote of the shingles' XXH64 bits; zero for a text without words."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(line)]
    total, votes = len(words) - shingle + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, BLOCK):
        upto = min(at + BLOCK, total)
        spans = zip(starts[at:upto], ends[at + shingle - 1 : upto + shingle - 1])
        hashes = np.array([digest(line[s:e], SEED) for s, e in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each 12-bit message, and the error of at most 3 bits behind each 11-bit syndrome."""
    messages = np.arange(1 << 12, dtype=np.uint32) << np.uint32(11)
    for bit in range(22, 10, -1):
        messages = np.where(messages >> np.uint32(bit) & np.uint32(1), messages ^ np.uint32(GENERATOR << (bit - 11)), messages)
    errors = np.zeros(1 << 11, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            errors[(word & 0x7FF) ^ int(messages[word >> 11])] = word
    return messages, errors


def homes(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    remainders, errors = tables
    syndromes = (words & np.uint32(0x7FF)) ^ remainders[words >> np.uint32(11)]
    return (words ^ errors[syndromes]) >> np.uint32(11)


def near(words: np.ndarray, width: int, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Near indices of each word, one row each: distinct ones ascending, then -1 up to six."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    found = np.sort(homes(words[:, None] ^ flips[None, :], tables).astype(np.int64), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = 1 << 12
    found = np.sort(found, axis=1)[:, :6]
    return np.where(found == 1 << 12, -1, found)


def keys_of(prints: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints, each once per fingerprint, and the row each belongs to."""
    segments, shift = [], 0
    for width in WIDTHS:
        segments.append((prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.uint32))
        shift += width
    home = [homes(s, tables).astype(np.int64) for s in segments]
    close = [near(s, w, tables) for s, w in zip(segments, WIDTHS)]
    columns = []
    for kind, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        own = (kind << 40) | (segments[i].astype(np.int64) << 12)
        columns.append(np.where(close[j] < 0, -1, own[:, None] | close[j]))
    for kind, (i, j) in enumerate(combinations(range(3), 2), start=6):
        left = np.where(close[i] < 0, -1, (kind << 40) | (close[i] << 12) | home[j][:, None])
        right = np.where(
            (close[j] < 0) | (close[j] == home[j][:, None]), -1, (kind << 40) | (home[i][:, None] << 12) | close[j]
        )
        columns += [left, right]
    keys = np.concatenate(columns, axis=1)
    rows, at = np.nonzero(keys >= 0)
    return keys[rows, at], rows


def _short_links(keys: np.ndarray, prints: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal keys (sorted), by comparing each row with the next, the next but one, ..."""
    left, right = [], []
    at, step = np.arange(len(keys) - 1), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        good = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= limit]
        left.append(prints[good])
        right.append(prints[good + step])
        step += 1
    return np.concatenate(left or [prints[:0]]), np.concatenate(right or [prints[:0]])


def _long_links(prints: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join each linked group among ``prints``, one less than the group has members."""
    open_ = prints
    while len(open_):
        waiting, open_ = [open_[0]], open_[1:]
        while waiting and len(open_):
            here = waiting.pop()
            hit = np.bitwise_count(open_ ^ here) <= limit
            if hit.any():
                found, open_ = open_[hit], open_[~hit]
                yield np.full(len(found), here), found
                waiting.extend(found)


class _Forest:
    """Drops links between fingerprints that earlier links of this batch already join."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def new(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for a, b in zip(left.tolist(), right.tolist()):
            ra, rb = self.root(a), self.root(b)
            if ra != rb:
                self.parent[ra] = rb
                out.append((a, b))
        return out


_LINKS = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("block", pa.int64())])


def _matched(batches: Iterator[pa.RecordBatch], limit: int, most: int) -> Iterator[pa.RecordBatch]:
    """Links among rows that arrive sorted by key. A key with over ``most`` rows comes out again in numbered blocks."""

    def links(keys: np.ndarray, prints: np.ndarray):
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        forest, out = _Forest(), []
        short = np.repeat((sizes > 1) & (sizes <= SHORT), sizes)
        out += forest.new(*_short_links(keys[short], prints[short], limit))
        for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
            for pair in _long_links(prints[start : start + size], limit):
                out += forest.new(*pair)
        if out:
            a, b = np.array(out, np.uint64).view(np.int64).T
            none = pa.nulls(len(out), pa.int64())
            yield batch_of(_LINKS, none, np.ascontiguousarray(a), np.ascontiguousarray(b), none)

    def spilled(key: int, prints: np.ndarray, seen: int):
        blocks = (seen + np.arange(len(prints))) // (most // 2)
        none = pa.nulls(len(prints), pa.int64())
        yield batch_of(_LINKS, np.full(len(prints), key), prints.view(np.int64), none, blocks)

    held_keys, held, over, seen = np.empty(0, np.int64), np.empty(0, np.uint64), None, 0
    for batch in batches:
        keys = np.concatenate([held_keys, batch.column("key").to_numpy()])
        prints = np.concatenate([held, batch.column("print").to_numpy().view(np.uint64)])
        if over is not None:
            cut = int(np.searchsorted(keys, over, "right"))
            yield from spilled(over, prints[:cut], seen)
            seen += cut
            keys, prints = keys[cut:], prints[cut:]
            if len(keys):
                over = None
        if not len(keys):
            held_keys, held = keys, prints
            continue
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield from links(keys[:cut], prints[:cut])
        held_keys, held = keys[cut:], prints[cut:]
        if len(held) > most:
            over, seen = int(held_keys[0]), len(held)
            yield from spilled(over, held, 0)
            held_keys, held = held_keys[:0], held[:0]
    if len(held):
        yield from links(held_keys, held)


def prints_of(
    df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id``, ``print`` (the fingerprint as a signed long) and ``carry`` columns of every whole text."""

    def printed(batches):
        for batch in pieces(batches):
            found = np.array([fingerprint(raw, shingle) for raw in as_bytes(batch.column("text"))], np.uint64)
            columns = [batch.column("doc_id"), pa.array(found.view(np.int64)), *[batch.column(c) for c in carry]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "print", *carry])

    more = "".join(f", {c} {type_of(df, c)}" for c in carry)
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry).mapInArrow(
        printed, f"doc_id {type_of(df, id_col)}, print long{more}"
    )


def links_of(prints: DataFrame, limit: int = LIMIT, most: int = BLOCK) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect all that are within ``limit`` bits, chains included.

    Not every link is returned, but enough to join the same groups: a dense
    group of n fingerprints yields links in proportion to n. A key shared by
    more than ``most`` rows is compared block by block, each pair of blocks in
    a task of its own.
    """
    if limit > LIMIT:
        raise ValueError(f"the keys find fingerprints within {LIMIT} bits")
    tables = golay_tables()
    schema = pa.schema([("key", pa.int64()), ("print", pa.int64())])

    def keyed(batches):
        for batch in pieces(batches, 4096):
            found = batch.column("print").to_numpy()
            keys, rows = keys_of(found.view(np.uint64), tables)
            yield batch_of(schema, keys, found[rows])

    def match(rows: DataFrame) -> DataFrame:
        sorted_ = rows.repartition("key").sortWithinPartitions("key")
        return staged(
            sorted_.mapInArrow(lambda batches: _matched(batches, limit, most), "key long, a long, b long, block long"), "links"
        )

    first = match(prints.mapInArrow(keyed, "key long, print long"))
    large = first.filter("b is null")
    links = first.filter("b is not null").select("a", "b")
    if large.isEmpty():
        return links
    last = large.groupBy("key").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    pairs = large.join(last, "key").withColumn("other", other)
    pairs = pairs.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), F.col("a").alias("print")
    )
    again = match(pairs)
    return links.unionByName(again.filter("b is not null").select("a", "b"))


def near_duplicates(
    df: DataFrame,
    shingle: int = 4,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    group: str | None = None,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    The component is the smallest id reachable over links of at most ``limit``
    bits. Equal fingerprints become one row first, so thousands of copies cost
    what one text costs. A null, empty or blank text has fingerprint zero,
    linked like any other; rows without id belong to their component but never
    name it. An empty table gives an empty result. ``carry`` columns of the row
    come along, and ``group`` names a column that tells components apart even
    if they share a name or have none.
    """
    prints = staged(prints_of(df, shingle, id_col, text_col, carry), "prints")
    known = staged(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    found = components(links_of(known.select("print"), limit)).withColumnRenamed("node", "print")
    grouped = known.join(found, "print")
    named = grouped.groupBy("component").agg(F.min("first").alias("name"))
    moved = grouped.join(named, "component").select("print", "name", "component")
    # stored, so that the join below meets two plain shuffles and a hot fingerprint's rows can be split
    names = known.join(moved, "print", "left").select(
        "print", F.coalesce("name", "first").alias("component_id"), *([F.coalesce("component", "print").alias(group)] if group else [])
    )
    result = prints.join(staged(names, "print-names"), "print", "left")
    fingerprint = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return result.select("doc_id", fingerprint, "component_id", *carry, *([group] if group else []))
