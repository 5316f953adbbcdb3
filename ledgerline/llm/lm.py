"""Language-model scoring by cross-entropy difference between a target and a background model.

Both models are interpolated bigram models over one vocabulary, estimated the
same way: the target from documents given as good, the background from all
documents. They count every word and every pair of words of the corpus. Texts are
taken in chunks; a chunk's words and pairs go out as packed lists of sorted keys
and counts, one list per bucket of keys. A bucket merges its lists and sends back,
in the order of each list, what the other chunks hold. A document's score is the
mean over its tokens of the background's loss less the target's: positive means
closer to the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, batch_of, pieces, staged, type_of

#: Bytes of text whose words and pairs are counted together before the shuffle.
CHUNK = 12 << 20
#: Weight of the bigram against the unigram estimate, in both models.
BIGRAM_WEIGHT = 0.7
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def tokens_of(raw: bytes) -> list[bytes]:
    """Words in lower case (A-Z), split at ASCII white space."""
    return raw.lower().split()


def repeats(values: np.ndarray) -> np.ndarray:
    """How often each value occurs among ``values``."""
    _, place, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[place]


def losses(
    ids: np.ndarray, pairs: np.ndarray, words_n: np.ndarray, pairs_n: np.ndarray, own: tuple[np.ndarray, np.ndarray] | None, total: int, size: int
) -> np.ndarray:
    """Loss in nats of each token; ``pairs`` are those that end in tokens 1, 2, ...

    ``own`` are the text's own counts of its tokens and pairs, taken off when the
    model has seen the text: no text vouches for itself. The model has ``total``
    tokens of ``size`` words.
    """
    total = float(total)
    words, both = words_n[ids].astype(np.float64), pairs_n[pairs].astype(np.float64)
    if own is not None:
        total, words, both = total - len(ids), words - own[0], both - own[1]
    single = (words + 1.0) / (total + size)
    out = single.copy()
    before, after = words[:-1], words[1:]
    pair = np.minimum(np.minimum(both, before), after)
    mixed = BIGRAM_WEIGHT * pair / np.maximum(before, 1) + (1 - BIGRAM_WEIGHT) * single[1:]
    out[1:] = np.where(before > 0, mixed, single[1:])
    return -np.log(out)


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _restored(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _packed(numbers: np.ndarray, kind: str) -> bytes:
    """Whole numbers as byte planes, compressed: small and frequent ones take little."""
    return _squeezed(np.ascontiguousarray(numbers.astype(kind)).view(np.uint8).reshape(len(numbers), np.dtype(kind).itemsize).T.tobytes())


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(_restored(raw), np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


_CHUNKS = "chunk long, good binary, lengths binary, ids binary, words binary, tokens long, good_tokens long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for about ``CHUNK`` bytes of text: its documents, their words numbered within the chunk, and the words."""
    names = ["doc_ids", *[c.split()[0] for c in _CHUNKS.split(", ")]]
    made, held = 0, 0
    docs, good, lists, number = [], [], [], {}

    def row() -> pa.RecordBatch:
        ids = pa.concat_arrays(docs)
        lengths, chosen = np.array([len(x) for x in lists], np.int64), np.array(good, bool)
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([TaskContext.get().partitionId() << 33 | made], pa.int64()),
            pa.array([chosen.tobytes()], pa.binary()),
            pa.array([_packed(lengths, "<i4")], pa.binary()),
            pa.array([_packed(np.concatenate(lists), "<i4")], pa.binary()),
            pa.array([_squeezed(b" ".join(number))], pa.binary()),
            pa.array([int(lengths.sum())], pa.int64()),
            pa.array([int(lengths[chosen].sum())], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in pieces(batches, size=CHUNK // 4):
        if not batch.num_rows:
            continue
        docs.append(batch.column("doc_id"))
        good += batch.column("good").to_pylist()
        for raw in as_bytes(batch.column("text")):
            lists.append(np.array([number.setdefault(w, len(number)) for w in tokens_of(raw)], np.int32))
            held += len(raw)
        if held >= CHUNK:
            yield row()
            made, held = made + 1, 0
            docs, good, lists, number = [], [], [], {}
    if docs:
        yield row()


class _Grams:
    """Words and pairs of a chunk: where they stand, their counts, and their keys, words first."""

    def __init__(self, good: bytes, lengths: bytes, ids: bytes, words: bytes):
        self.length, self.word = _unpacked(lengths, "<i4").astype(np.int64), _unpacked(ids, "<i4").astype(np.int64)
        found = _restored(words).split()
        self.size = len(found)
        self.good = np.frombuffer(good, bool)
        chosen = np.repeat(self.good, self.length)
        doc = np.repeat(np.arange(len(self.length)), self.length)
        inside = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        distinct, place = np.unique(self.word[inside - 1] * max(self.size, 1) + self.word[inside], return_inverse=True)
        #: the pair that ends at each place, -1 at a text's first
        self.pair = np.full(len(self.word), -1)
        self.pair[inside] = place
        both = np.concatenate([self.word, self.size + place])
        entries = self.size + len(distinct)
        self.n = np.bincount(both, minlength=entries)
        self.g = np.bincount(both[np.concatenate([chosen, chosen[inside]])], minlength=entries)
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), "<u8").reshape(-1, 2)
        self.key, self.check = _keys(hashes, distinct // max(self.size, 1), distinct % max(self.size, 1))

    def lists(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """Entries of each bucket in the order of their keys; the same in every run."""
        bucket = (self.check.astype(np.int64) >> 1) * 131 + (self.key >> np.uint64(7)).astype(np.int64) & 0x7FFFFFFF
        bucket %= buckets
        order = np.lexsort((self.check, self.key, bucket))
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(part):
                yield int(bucket[part[0]]), part


def _keys(h: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """80 bits for each word, then for each pair of words; the last bit tells them apart.

    At ten thousand million distinct ones, two of them agree with a chance of 1 in 10,000.
    """
    a, b = h[left], h[right]
    mixed = (a[:, 0] ^ a[:, 0] >> np.uint64(29)) * _A + (b[:, 0] ^ b[:, 0] >> np.uint64(31)) * _B
    mixed = (mixed ^ mixed >> np.uint64(32)) * _B
    check = (a[:, 1] * _A + (b[:, 1] ^ b[:, 1] >> np.uint64(31)) * _B) >> np.uint64(49)
    one, two = (h[:, 1] >> np.uint64(49)) << np.uint64(1), check << np.uint64(1) | np.uint64(1)
    return np.concatenate([h[:, 0], mixed]), np.concatenate([one, two]).astype(np.uint16)


_LISTS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64())] + [(c, pa.binary()) for c in ("keys", "checks", "n", "g")])
_LISTS_TYPES = "bucket long, chunk long, keys binary, checks binary, n binary, g binary"


def _sent(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Keys and counts of each chunk, a row per bucket."""
    for batch in pieces(batches, 1):
        for row in batch.to_pylist():
            grams = _Grams(row["good"], row["lengths"], row["ids"], row["words"])
            for bucket, part in grams.lists(buckets):
                keys = grams.key[part]
                steps = np.diff(keys, prepend=np.uint64(0))
                packed = _packed(steps, "<u8"), _packed(grams.check[part], "<u2"), _packed(grams.n[part], "<u4"), _packed(grams.g[part], "<u4")
                yield batch_of(_LISTS, [bucket], [row["chunk"]], *[[p] for p in packed])


_ANSWERS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.binary()), ("g", pa.binary()), ("words", pa.int64())])
_ANSWERS_TYPES = "bucket long, chunk long, n binary, g binary, words long"


def _merged(lists: pa.Table) -> pa.Table:
    """For each list of a bucket the counts in all other lists, in its order; ``words`` adds up to the bucket's distinct words."""
    keys = [np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64) for raw in lists.column("keys").to_pylist()]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    key = np.concatenate(keys)
    check, n, g = (
        np.concatenate([_unpacked(raw, kind) for raw in lists.column(c).to_pylist()]) for c, kind in (("checks", "<u2"), ("n", "<u4"), ("g", "<u4"))
    )
    order = np.lexsort((check, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    words = int((check[order][new] & 1 == 0).sum())
    others = [np.bincount(group, weights=v, minlength=0)[group].astype(np.int64) - v for v in (n.astype(np.int64), g.astype(np.int64))]
    rows = [[_packed(part, "<u8") for part in np.split(v, ends)] for v in others]
    return pa.Table.from_batches(
        [batch_of(_ANSWERS, lists.column("bucket").combine_chunks(), lists.column("chunk").combine_chunks(), *rows, [words] + [0] * (lists.num_rows - 1))]
    )


_SCORES = pa.schema(
    [("n_tokens", pa.int64())] + [(c, pa.float64()) for c in ("target_loss", "background_loss", "score")] + [("selected", pa.bool_())]
)
_SCORE_TYPES = "n_tokens long, target_loss double, background_loss double, score double, selected boolean"
_NO_WORDS = (0, None, None, 0.0, False)


def _scored(chunks: pa.Table, answers: pa.Table, buckets: int, total: int, good_total: int, size: int) -> pa.Table:
    """Scores of the documents of one chunk, from its own counts and what the buckets say of all others."""
    out, docs = [], []
    by_bucket = {b: (n, g) for b, n, g in zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "g")))}
    for row in range(chunks.num_rows):
        grams = _Grams(*[chunks.column(c)[row].as_py() for c in ("good", "lengths", "ids", "words")])
        all_n, all_g = grams.n.copy(), grams.g.copy()
        for bucket, part in grams.lists(buckets):
            n, g = by_bucket[bucket]
            all_n[part] += _unpacked(n, "<u8").astype(np.int64)
            all_g[part] += _unpacked(g, "<u8").astype(np.int64)
        first, end = grams.size, 0
        for is_good, tokens in zip(grams.good.tolist(), grams.length.tolist()):
            start, end = end, end + tokens
            if not tokens:
                out.append(_NO_WORDS)
                continue
            ids, pairs = grams.word[start:end], grams.pair[start + 1 : end]
            own = repeats(ids), repeats(pairs)
            target = float(losses(ids, pairs, all_g[:first], all_g[first:], own if is_good else None, good_total, size).mean())
            background = float(losses(ids, pairs, all_n[:first], all_n[first:], own, total, size).mean())
            out.append((tokens, target, background, background - target, background > target))
        docs.append(chunks.column("doc_ids")[row].values)
    made = batch_of(_SCORES, *(zip(*out) if out else [[]] * len(_SCORES)))
    ids = pa.chunked_array(docs, chunks.schema.field("doc_ids").type.value_type)
    return pa.Table.from_arrays([ids, *made.columns], names=["doc_id", *_SCORES.names])


def cross_entropy_difference(
    df: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score, selected`` for every row of ``df``.

    ``good`` holds the ids of target documents. Both models count every word and
    pair of words of all whole texts, so they grow with the corpus; no table of
    them is collected or broadcast. Words and pairs are dealt into ``buckets``, by
    default as many as there are chunks, so that a bucket holds about as much as a
    chunk; a frequent word is one entry of each chunk's list.
    A document's own counts are taken off before it is scored.
    Losses are means per token; a text without words has none, score 0 and is
    not selected. Without any target document both models see what they can:
    the target falls back to equal word probabilities. Rows that repeat an id
    are all targets if the id is; a null id never is.
    """
    wanted = good.select(F.col(id_col).alias("doc_id")).filter("doc_id is not null").distinct().withColumn("good", F.lit(True))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the ids' side grows with the labels, so it is broadcast at no size
    marked = rows.join(wanted.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"))
    id_type = type_of(df, id_col)
    chunks = staged(marked.mapInArrow(_chunks, f"doc_ids array<{id_type}>, {_CHUNKS}"), "chunks")
    seen = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.sum("tokens").alias("n"), F.sum("good_tokens").alias("g")).first()
    if buckets is None:
        buckets = max(8, seen["chunks"])
    lists = chunks.drop("doc_ids").mapInArrow(lambda b: _sent(b, buckets), _LISTS_TYPES)
    answers = staged(lists.groupBy("bucket").applyInArrow(_merged, _ANSWERS_TYPES), "counts")
    # one more word is the unknown one
    size = (answers.agg(F.sum("words")).first()[0] or 0) + 1
    total, good_total = seen["n"] or 0, seen["g"] or 0
    return (
        chunks.groupBy("chunk")
        .cogroup(answers.drop("words").groupBy("chunk"))
        .applyInArrow(
            lambda left, right: _scored(left, right, buckets, total, good_total, size), f"doc_id {id_type}, {_SCORE_TYPES}"
        )
    )
