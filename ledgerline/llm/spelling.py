"""Spelling variants by blocked Gram matrices.

Words of one length whose letters fall alike into a few groups form a block. One
edit changes the length by at most one and the groups' counts by at most one
each, so a block meets only the blocks that such a step reaches. Within a meeting
the NumPy product of the letter-count matrices gives all squared distances; pairs
of words at most two apart are then checked letter by letter.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, pieces, staged

#: What becomes of a Latin-1 byte: letters stay, A-Z are lowered, all else separates.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 0 for b in range(256))
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_LINKS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
#: Pairs of words in one Gram matrix, at most.
CELLS = 1 << 22


def _prefix_shift(prefix: bytes, lengths: range) -> np.ndarray:
    """What ``prefix`` adds to the crc32 of a run of each length: crc32 is linear over exclusive or."""
    start = zlib.crc32(prefix)
    return np.array([zlib.crc32(bytes(n), start) ^ zlib.crc32(bytes(n)) for n in lengths], np.uint32)


def _utf8(run: bytes) -> bytes:
    return run if run.isascii() else run.decode("latin-1").encode("utf-8")


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of a text cut between runs."""
    start = 0
    while len(text) - start > size:
        end = text.find(b"\0", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def _count_runs(buffer: np.ndarray, ends: np.ndarray, prefixes: list[bytes], every: int, least: int) -> Counter:
    """Occurrences of the runs in ``buffer``, where document ``i`` ends at ``ends[i]``."""
    held = np.concatenate([[False], buffer != 0, [False]])
    edges = np.flatnonzero(held[1:] != held[:-1])
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= least
    starts, stops = starts[long], stops[long]
    sizes = stops - starts
    if not len(sizes):
        return Counter()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    turns = np.zeros(len(buffer) + 1, np.int8)
    turns[starts], turns[stops] = 1, -1
    letters = buffer[np.cumsum(turns[:-1], dtype=np.int8).view(bool)]
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    codes, words = runs.indices.to_numpy(), runs.dictionary.to_pylist()
    wide = [_utf8(w) for w in words]
    crc = np.array([zlib.crc32(w) for w in wide], np.uint32)
    bytes_of = np.array([len(w) for w in wide])
    lengths, kind = np.unique(bytes_of, return_inverse=True)
    shifts = np.stack([_prefix_shift(p, lengths.tolist()) for p in prefixes])
    doc = np.searchsorted(ends, starts, side="right")
    hashes = crc[codes] ^ shifts[doc, kind[codes]]
    cut = hashes % every == 0
    found = Counter()
    for code, count in enumerate(np.bincount(codes[~cut], minlength=len(words)).tolist()):
        if count:
            found[words[code]] = count
    for code, value in zip(codes[cut].tolist(), hashes[cut].tolist()):
        word = words[code]
        at = value % len(word)
        found[word[:at] + word[at + 1 :]] += 1
    return found


def _runs(batches: Iterator[pa.RecordBatch], every: int, least: int, size: int) -> Iterator[pa.RecordBatch]:
    """Words of ``least`` letters or more and how often they stand in each slice of documents."""
    for batch in pieces(batches, 4096, size):
        parts, ends, prefixes, held = [], [], [], 0

        def counted() -> pa.RecordBatch:
            buffer = np.frombuffer(b"".join(parts), np.uint8)
            found = _count_runs(buffer, np.array(ends), prefixes, every, least)
            kept = [(w.decode("latin-1"), n) for w, n in found.items() if len(w) >= least]
            return batch_of(_COUNTS, [w for w, _ in kept], [n for _, n in kept])

        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            letters = (text or b"").decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS)
            for part in _slices(letters, size):
                parts += [part, b"\0"]
                held += len(part) + 1
                ends.append(held)
                prefixes.append(b"%s:" % (number or "").encode())
                if held >= size:
                    yield counted()
                    parts, ends, prefixes, held = [], [], [], 0
        if held:
            yield counted()


def word_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least: int = 6, size: int = 16 << 20
) -> DataFrame:
    """``word, n``: runs of Latin letters in lower case with their occurrences, from whole texts.

    A run whose crc32 of ``<id>:<run>`` is divisible by ``every`` loses the code
    point at that number modulo its length, in all its places of that document. A
    null id reads as empty. Counts are added up per slice of ``size`` bytes and
    before the shuffle, so a frequent word is a few rows.
    """
    rows = df.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").cast("binary").alias("t"))
    found = rows.mapInArrow(lambda batches: _runs(batches, every, least, size), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _letter_counts(rows: np.ndarray, column: np.ndarray, width: int, kind: type) -> np.ndarray:
    found = np.zeros((len(rows), width), kind)
    every = np.arange(len(rows))
    for place in range(rows.shape[1]):
        found[every, column[rows[:, place]]] += 1
    return found


def near_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs one edit apart; ``right`` is as long as ``left`` or one letter longer."""
    kind = np.float32 if right.shape[1] < 4096 else np.float64  # sums of squares stay exact
    letters = np.union1d(left, right)
    column = np.zeros(256, np.int64)
    column[letters] = np.arange(len(letters))
    a, b = (_letter_counts(m, column, len(letters), kind) for m in (left, right))
    distance = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(distance <= 2)
    s, t = left[i], right[j]
    if left.shape[1] == right.shape[1]:
        good = (s != t).sum(1) == 1
    else:
        head = np.logical_and.accumulate(s == t[:, :-1], 1).sum(1)
        tail = np.logical_and.accumulate((s == t[:, 1:])[:, ::-1], 1).sum(1)
        good = head + tail >= left.shape[1]
    return i[good], j[good]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meet each block with the rows that follow it; its own row comes first."""
    name, own, waiting, held = None, None, {}, 0

    def met() -> Iterator[pa.RecordBatch]:
        words, counts, rows = own
        for size, parts in waiting.items():
            others = [w for p, _ in parts for w in p]
            other_counts = [n for _, q in parts for n in q]
            step = max(1, CELLS // max(1, len(words)))
            for start in range(0, len(others), step):
                i, j = near_pairs(rows, _matrix(others[start : start + step]))
                yield from told(words, counts, others, other_counts, i, j + start)

    def told(words, counts, others, other_counts, i, j) -> Iterator[pa.RecordBatch]:
        i, j = i.tolist(), j.tolist()
        yield batch_of(
            _LINKS,
            [words[k] for k in i] + [others[k] for k in j],
            [others[k] for k in j] + [words[k] for k in i],
            [other_counts[k] for k in j] + [counts[k] for k in i],
        )

    for batch in pieces(batches, 64):
        for key, chunk, itself, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, chunk) != name:
                if own and waiting:
                    yield from met()
                name, own, waiting, held = (key, chunk), None, {}, 0
            if itself:
                own = words, counts, _matrix(words)
                i, j = near_pairs(own[2], own[2])
                once = i < j
                yield from told(words, counts, words, counts, i[once], j[once])
                continue
            waiting.setdefault(len(words[0]), []).append((words, counts))
            held += len(words)
            if held * len(own[0]) > CELLS:
                yield from met()
                waiting, held = {}, 0
    if own and waiting:
        yield from met()


def steps_of(groups: int) -> list[list[int]]:
    """Changes of (length, counts of the groups) that one edit can make, each in one direction only."""
    steps = [[0] * (groups + 1)]
    for i in range(groups):
        steps.append([1] + [int(g == i) for g in range(groups)])
        steps += [[0] + [int(g == j) - int(g == i) for g in range(groups)] for j in range(i + 1, groups)]
    return steps


def near_words(words: DataFrame, groups: int, rows: int = 2048) -> DataFrame:
    """``word, near, near_n``: both directions of every pair of ``words`` (word, n) exactly one edit apart.

    A block of more than ``rows`` words is dealt out in parts by a hash of the
    word, and parts meet in tasks of their own; so neither a block nor what it
    meets has to fit in one task.
    """
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    shares = ["".join(c for c in letters if ord(c) % groups == g) for g in range(groups)]
    sized = [F.length("word") - F.length(F.translate("word", s, "")) for s in shares]
    keyed = words.select(F.array(F.length("word"), *sized).alias("key"), "word", "n")
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts"))
    dealt = keyed.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("parts")))
    packed = F.collect_list(F.struct("word", "n")).alias("w")
    blocks = staged(dealt.groupBy("key", "chunk").agg(packed), "blocks").select(
        "key", "chunk", F.col("w.word").alias("words"), F.col("w.n").alias("counts")
    )
    names = blocks.select("key", "chunk")
    steps = F.array(*[F.array(*map(F.lit, s)) for s in steps_of(groups)])
    reached = names.withColumn("step", F.explode(steps)).select(
        F.col("key").alias("home"),
        F.col("chunk").alias("home_chunk"),
        F.zip_with("key", "step", lambda k, s: k + s).alias("key"),
    )
    pairs = reached.join(names, "key").filter("key <> home or chunk > home_chunk")
    others = pairs.join(blocks, ["key", "chunk"]).select("home", "home_chunk", F.lit(False).alias("own"), "words", "counts")
    own = blocks.select(F.col("key").alias("home"), F.col("chunk").alias("home_chunk"), F.lit(True).alias("own"), "words", "counts")
    return (
        own.unionByName(others)
        .repartition("home", "home_chunk")
        .sortWithinPartitions("home", "home_chunk", F.desc("own"))
        .mapInArrow(_links, "word string, near string, near_n long")
    )


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """``word, root`` of every word that has a form; each round doubles the way that is followed."""
    found = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = staged(
            found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
    return found


def variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_n: int = 5, ratio: int = 5, groups: int | None = None
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of six letters or more found ``least_n`` times or more.

    Words are those of ``word_counts``. Near words differ by exactly one inserted,
    deleted or replaced letter. A word's form is its most frequent near word (of
    equally frequent ones the first in code-point order) if found at least
    ``ratio`` times as often; else null, as is ``form_n``. Its root is where the
    forms end, the word itself without a form. Letters are dealt into ``groups``
    groups to name blocks, by default more for larger vocabularies; this changes
    the work, not the result. Null and empty texts have no words, repeated rows
    count as often as they stand, an empty table gives an empty result.
    """
    words = staged(word_counts(df, id_col, text_col).filter(F.col("n") >= least_n), "words")
    total, most = words.agg(F.count(F.lit(1)), F.max("n")).first()
    if groups is None:
        groups = min(16, max(2, round(math.log2(total + 1) / 2.4)))
    links = near_words(words, groups)
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("b"))
    best = staged(best.select("word", "n_near", "b.form", (-F.col("b.less")).alias("form_n")), "near")
    large = F.col("form_n") >= ratio * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *[F.when(large, F.col(c)).alias(c) for c in ("form", "form_n")],
    )
    judged = staged(judged, "judged")
    steps = 0  # of the longest way along forms: each form is found at least ``ratio`` times as often
    while (least_n * ratio ** (steps + 1)) <= (most or 0):
        steps += 1
    roots = _roots(judged.filter("form is not null").select("word", "form"), max(0, steps - 1).bit_length())
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
