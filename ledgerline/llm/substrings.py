"""Substring dedup: recurring passages found through repeated phrases and located by sharded Aho-Corasick automata.

Every window of 20 words belongs to the one of its 15 six-word phrases that has
the smallest hash, so equal windows belong to the same phrase wherever they
stand. That phrase is the shard key: all places where a window could recur meet
in one shard, and no document has to pass through every shard.

1. Phrases that occur once in the corpus are set aside: their windows cannot recur.
2. Documents are cut into passages, the runs of windows of one recurring phrase.
3. Each shard confirms which windows recur among its passages, compiles those
   into an automaton over words and streams its passages through it. Every
   place but the first one of a window is removed.
4. Places are gathered per document and cut out of its words.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, batch_of, pieces, staged, type_of

WINDOW = 20
PHRASE = 6
#: Phrases and passages a task holds before it passes them on.
HELD, HELD_PASSAGES = 400_000, 50_000
#: Passages of one phrase that a task takes together; a larger set is dealt out by window.
MOST = 5_000
#: Passages compiled into one automaton (more only if one phrase has more).
COMPILED = 1_000
_FIRST = -(1 << 63)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def phrase_hashes(words: list[bytes], phrase: int = PHRASE) -> np.ndarray:
    """A 64-bit hash of each run of ``phrase`` words; only equality is used, and texts are compared later."""
    digest = xxhash.xxh64_intdigest
    single = np.array([digest(w) for w in words], np.uint64)
    n = len(words) - phrase + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(phrase if n > 0 else 0):
        out = out * _STEP + single[j : n + j]
    out ^= out >> np.uint64(29)
    out *= _MIX
    return out ^ (out >> np.uint64(32))


def owners(hashes: np.ndarray, window: int = WINDOW, phrase: int = PHRASE) -> np.ndarray:
    """The smallest phrase hash in each window."""
    span = window - phrase + 1
    n = len(hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # minima over 1, 2, 4, ... places, then two overlapping ones
    width, low = 1, hashes
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:n], low[span - width : span - width + n])


def runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and owner of each run of windows with one owner."""
    cuts = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    first = np.concatenate([[0], cuts])
    return first, np.concatenate([cuts, [len(owner)]]) - 1, owner[first]


_MARKS = pa.schema([("route", pa.int64()), ("text_key", pa.int64()), ("mark", pa.int64())])


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per phrase and text for the shuffle; a phrase met twice in this task is marked at once."""
    hashes: list[np.ndarray] = []
    keys: list[np.ndarray] = []
    held = 0

    def flush():
        h, k = np.concatenate(hashes), np.concatenate(keys)
        order = np.lexsort((k, h))
        h, k = h[order], k[order]
        fresh = np.concatenate([[True], h[1:] != h[:-1]])
        again = np.zeros(len(h), bool)
        again[1:] |= ~fresh[1:]
        again[:-1] |= ~fresh[1:]
        # copies of a text say the same, so it is said once; routes of marked rows only spread them
        again &= np.concatenate([[True], fresh[1:] | (k[1:] != k[:-1])])
        spread = (h[again] ^ k[again].view(np.uint64)) * _MIX
        yield batch_of(_MARKS, h[fresh].view(np.int64), k[fresh], pa.nulls(int(fresh.sum()), pa.int64()))
        yield batch_of(_MARKS, spread.view(np.int64), k[again], h[again].view(np.int64))

    for batch in pieces(batches):
        for raw, key in zip(as_bytes(batch.column("text")), batch.column("text_key").to_pylist()):
            words = raw.split()
            if len(words) < WINDOW:
                continue
            found = phrase_hashes(words)
            own = np.unique(owners(found))
            found.sort()
            twice = own[np.isin(own, found[1:][found[1:] == found[:-1]])]
            for h in (own, twice):  # twice in one text: listed twice, so marked
                hashes.append(h)
                keys.append(np.full(len(h), key, np.int64))
                held += len(h)
            if held >= HELD:
                yield from flush()
                hashes, keys, held = [], [], 0
    if held:
        yield from flush()


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, mark) for phrases with two rows or more; rows come sorted by route. Holds one row at a time."""
    schema = pa.schema([("text_key", pa.int64()), ("mark", pa.int64())])
    last: tuple[int, int, bool] | None = None
    for batch in batches:
        marked = batch.filter(batch.column("mark").is_valid())
        yield batch_of(schema, marked.column("text_key"), marked.column("mark"))
        rest = batch.filter(batch.column("mark").is_null())
        route, key = rest.column("route").to_numpy(), rest.column("text_key").to_numpy()
        if not len(route):
            continue
        same = np.zeros(len(route), bool)
        equal = route[1:] == route[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        if last is not None and last[0] == route[0]:
            same[0] = True
            if not last[2]:
                yield batch_of(schema, [last[1]], [last[0]])
        yield batch_of(schema, key[same], route[same])
        last = (int(route[-1]), int(key[-1]), bool(same[-1]))


_PASSAGES = pa.schema(
    [
        ("route", pa.int64()), ("passage", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()),
        ("lo", pa.int64()), ("hi", pa.int64()),
    ]
)
_PASSAGE_TYPES = "route long, passage binary, doc long, text_key long, lo long, hi long"


class _Passages:
    """Passages of a task, each text once: the earliest place is sent on, later ones are already known repeats."""

    def __init__(self):
        self.first: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
        self.repeats: list[tuple[int, int, int, int]] = []

    def add(self, route: int, passage: bytes, doc: int, text_key: int, lo: int, hi: int) -> None:
        place = (doc, lo, hi, text_key)
        before = self.first.setdefault((route, passage), place)
        if before[:2] == place[:2]:
            return
        if place[:2] < before[:2]:
            self.first[(route, passage)], place = place, before
        self.repeats.append((place[0], place[3], place[1], place[2]))

    def __len__(self) -> int:
        return len(self.first) + len(self.repeats)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Passages to confirm, and rows without passage for words (lo to hi) to remove."""
        sent = [(r, p, d, k, lo, hi) for (r, p), (d, lo, hi, k) in self.first.items()]
        for at in range(0, len(sent), 20_000):
            yield batch_of(_PASSAGES, *zip(*sent[at : at + 20_000]))
        merged = _merged(self.repeats)
        for at in range(0, len(merged), 50_000):
            doc, key, lo, hi = zip(*merged[at : at + 50_000])
            yield batch_of(_PASSAGES, doc, pa.nulls(len(doc), pa.binary()), doc, key, lo, hi)
        self.__init__()


def _merged(places: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Word ranges (doc, key, from, to) with those that touch or overlap joined."""
    out: list[tuple[int, int, int, int]] = []
    for doc, key, lo, hi in sorted(places):
        if out and out[-1][0] == doc and out[-1][1] == key and lo <= out[-1][3] + 1:
            out[-1] = (doc, key, out[-1][2], max(hi, out[-1][3]))
        else:
            out.append((doc, key, lo, hi))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of recurring phrases in each document."""
    held = _Passages()
    for batch in pieces(batches, 256):
        columns = (batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), batch.column("marks").to_pylist())
        for raw, doc, key, marks in zip(as_bytes(batch.column("text")), *columns):
            words = raw.split()
            if len(words) < WINDOW:
                continue
            first, last, owner = runs(owners(phrase_hashes(words)))
            hit = np.isin(owner.view(np.int64), np.array(marks, np.int64))
            for lo, end, own in zip(first[hit].tolist(), last[hit].tolist(), owner[hit].view(np.int64).tolist()):
                hi = end + WINDOW - 1
                held.add(own, b" ".join(words[lo : hi + 1]), doc, key, lo, hi)
            if len(held) >= HELD_PASSAGES:
                yield from held.rows()
    yield from held.rows()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of passages, routed by their own words: the way for phrases with very many passages."""
    held = _Passages()
    for batch in pieces(batches):
        columns = [batch.column(c).to_pylist() for c in ("passage", "doc", "text_key", "lo")]
        for passage, doc, key, lo in zip(*columns):
            words = passage.split(b" ")
            for at in range(len(words) - WINDOW + 1):
                window = b" ".join(words[at : at + WINDOW])
                route = xxhash.xxh64_intdigest(window) - (1 << 63)
                held.add(route, window, doc, key, lo + at, lo + at + WINDOW - 1)
            if len(held) >= HELD_PASSAGES:
                yield from held.rows()
    yield from held.rows()


def _located(passages: list[tuple[bytes, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Words to remove, from all passages (text, doc, key, lo) of some phrases.

    Windows seen at two places are confirmed as recurring, with their first
    place; an automaton over word numbers then finds all their places.
    """
    import ahocorasick

    numbers: dict[bytes, int] = {}
    streams = [array("I", [numbers.setdefault(w, len(numbers)) for w in p[0].split(b" ")]) for p in passages]
    first: dict[bytes, tuple[int, int]] = {}
    recurring: set[bytes] = set()
    for stream, (_, doc, _, lo) in zip(streams, passages):
        raw, width = stream.tobytes(), stream.itemsize
        for at in range(len(stream) - WINDOW + 1):
            window, place = raw[width * at : width * (at + WINDOW)], (doc, lo + at)
            before = first.setdefault(window, place)
            if before is not place:
                recurring.add(window)
                if place < before:
                    first[window] = place
    if not recurring:
        return []
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window in recurring:
        machine.add_word(tuple(array("I", window)), first[window])
    machine.make_automaton()
    out = []
    for stream, (_, doc, key, lo) in zip(streams, passages):
        start = end = -1
        for last, place in machine.iter(tuple(stream)):
            at = lo + last - WINDOW + 1
            if place == (doc, at):
                continue
            if at > end + 1 or start < 0:
                if start >= 0:
                    out.append((doc, key, start, end))
                start = at
            end = lo + last
        if start >= 0:
            out.append((doc, key, start, end))
    return _merged(out)


def _may_repeat(group: list[tuple[bytes, int, int, int]]) -> bool:
    """Several passages, or one in which a window can recur: then at least 20 of its words are not new."""
    if len(group) != 1:
        return len(group) > 1
    words = group[0][0].split(b" ")
    return len(words) - len(set(words)) >= WINDOW


def _sharded(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Ranges to remove, from rows sorted by route. Passages of a phrase that has over ``most`` come out again."""
    ready: list[tuple[bytes, int, int, int]] = []
    group: list[tuple[bytes, int, int, int]] = []
    now, over = None, False

    def ranges(places):
        if places:
            doc, key, lo, hi = zip(*places)
            none = pa.nulls(len(doc), pa.binary())
            yield batch_of(_PASSAGES, key, none, doc, key, lo, hi)

    def again(rows):
        passage, doc, key, lo = zip(*rows)
        none = pa.nulls(len(rows), pa.int64())
        yield batch_of(_PASSAGES, [now] * len(rows), passage, doc, key, lo, none)

    for batch in batches:
        known = batch.filter(batch.column("passage").is_null())
        if known.num_rows:
            yield known
        rest = batch.filter(batch.column("passage").is_valid())
        columns = [rest.column(c).to_pylist() for c in ("route", "passage", "doc", "text_key", "lo")]
        for route, *row in zip(*columns):
            if route != now:
                if over:
                    if group:
                        yield from again(group)
                elif _may_repeat(group):
                    ready += group
                    if len(ready) >= COMPILED:
                        yield from ranges(_located(ready))
                        ready = []
                now, group, over = route, [], False
            group.append(tuple(row))
            if len(group) > most:
                yield from again(group)
                group, over = [], True
    if over:
        if group:
            yield from again(group)
    elif _may_repeat(group):
        ready += group
    yield from ranges(_located(ready))


def repeated_places(df: DataFrame, most: int = MOST) -> DataFrame:
    """Word ranges (doc, text_key, lo, hi) to remove, from rows (doc, text_key, text)."""
    marks = (
        df.select("text_key", "text")
        .mapInArrow(_phrases, "route long, text_key long, mark long")
        .repartition("route")
        .sortWithinPartitions("route")
        .mapInArrow(_recurring, "text_key long, mark long")
    )
    # stored, so that the join below meets two plain shuffles and the rows of a text with many copies can be split
    marks = staged(marks.groupBy("text_key").agg(F.collect_set("mark").alias("marks")), "marks")
    passages = df.join(marks, "text_key").select("doc", "text_key", "text", "marks").mapInArrow(_cut, _PASSAGE_TYPES)

    def sharded(rows: DataFrame, most: int) -> DataFrame:
        dealt = rows.repartition("route").sortWithinPartitions("route")
        return staged(dealt.mapInArrow(lambda batches: _sharded(batches, most), _PASSAGE_TYPES), "passages")

    found = sharded(passages, most)
    places = found.filter("passage is null").select("doc", "text_key", "lo", "hi")
    large = found.filter("passage is not null")
    if large.isEmpty():
        return places
    single = sharded(large.mapInArrow(_windows, _PASSAGE_TYPES), 1 << 62)
    return places.unionByName(single.select("doc", "text_key", "lo", "hi"))


def _kept(batches: Iterator[pa.RecordBatch], with_text: bool, carry: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        counts, removed, digests, texts = [], [], [], []
        originals = batch.column("text").to_pylist()
        for raw, original, places in zip(as_bytes(batch.column("text")), originals, batch.column("places").to_pylist()):
            words = raw.split()
            kept = words
            if places:
                gone = np.zeros(len(words), bool)
                for place in places:
                    gone[place["lo"] : place["hi"] + 1] = True
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
            line = b" ".join(kept)
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(line).hexdigest())
            if with_text:
                texts.append(line.decode("utf-8") if len(kept) < len(words) else original)
        made = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            made.append(pa.array(texts, pa.string()))
            names.append("kept_text")
        made += [batch.column(f"_{c}") for c in carry]
        names += carry
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=names)


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
    carry: Sequence[str] = (),
    most: int = MOST,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row (``kept_text`` and ``carry`` columns on request).

    A word goes if it stands in a window of 20 words that also starts earlier:
    in a document of smaller id, or earlier in its own. Ids are whole numbers
    and a null id comes first; rows that repeat an id and its text count as
    one place, so neither loses words to the other. A null, empty or short text
    loses nothing but what earlier windows cover. ``kept_text`` is the kept
    words joined by blanks, or the text itself where nothing went. An empty
    table gives an empty result.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("doc"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(c).alias(f"_{c}") for c in carry],
    ).withColumn("text_key", F.xxhash64("text"))
    whole = rows.filter("text is not null").select("doc", "text_key", "text")
    places = repeated_places(whole, most).groupBy("doc", "text_key")
    places = places.agg(F.collect_list(F.struct("lo", "hi")).alias("places"))
    joined = rows.join(places, ["doc", "text_key"], "left")
    joined = joined.select("doc_id", "text", "places", *[f"_{c}" for c in carry])
    extra = ", kept_text string" if with_text else ""
    extra += "".join(f", {c} {type_of(df, c)}" for c in carry)
    return joined.mapInArrow(
        lambda batches: _kept(batches, with_text, tuple(carry)),
        f"doc_id {type_of(df, id_col)}, n_words long, n_removed long, kept_sha256 string{extra}",
    )
