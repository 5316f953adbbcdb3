"""BPE encoding through a table of distinct words, and decoding through an id-to-piece table.

Texts are split into words once, in batches of documents, and a document becomes
the codes of its words in the batch's word list. The lists are dealt out by
word, so each distinct word meets in one bucket and is encoded once there. The
ids go back to the batches, where they take the words' places by code, and
each id takes its piece from the vocabulary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, pieces, type_of
from ledgerline.llm.tokens import encoder_of, shipped, split_column

DOCS_PER_BATCH = 4096
BYTES_PER_BATCH = 16 << 20


def _coded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word offsets, codes and words of a batch, the most frequent first."""
    offsets, words = split_column(batch.column("text"))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return offsets, rank[codes], coded.dictionary.take(pa.array(order)).to_pylist()


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as byte planes, compressed: small and frequent numbers take little."""
    return _squeezed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(_restored(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _restored(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch of documents: their ids, the codes of their words, and the words."""
    names, made = ["batch", "doc_ids", "sizes", "codes", "words"], 0
    for batch in pieces(batches, DOCS_PER_BATCH, BYTES_PER_BATCH):
        if not batch.num_rows:
            continue
        offsets, codes, words = _coded(batch)
        ids = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId() << 33 | made], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([_packed(np.diff(offsets))], pa.binary()),
                pa.array([_packed(codes)], pa.binary()),
                pa.array([_squeezed(" ".join(words).encode("utf-8"))], pa.binary()),
            ],
            names=names,
        )
        made += 1


_LISTS = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("codes", pa.binary()), ("words", pa.binary())])


def _word_lists(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words of each batch, one row per bucket of words."""
    digest = xxhash.xxh64_intdigest
    for batch in pieces(batches, 1):
        for name, packed in zip(batch.column("batch").to_pylist(), batch.column("words").to_pylist()):
            text = _restored(packed)
            if not text:
                continue
            raw = text.split(b" ")
            bucket = np.array([digest(w) % buckets for w in raw])
            order = np.argsort(bucket, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
            yield batch_of(
                _LISTS,
                [int(bucket[g[0]]) for g in groups],
                [name] * len(groups),
                [_packed(np.diff(g, prepend=0)) for g in groups],
                [_squeezed(b" ".join([raw[i] for i in g.tolist()])) for g in groups],
            )


_ANSWERS = pa.schema([("batch", pa.int64()), ("codes", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])


def _answers(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Ids for the words of each list; lists come by bucket, and a word is encoded when its bucket first holds it."""
    encoder, known, here = encoder_of(shared), {}, None
    for batch in pieces(batches, 64):
        lists = [_restored(w).decode("utf-8").split(" ") for w in batch.column("words").to_pylist()]
        found = []
        for bucket, words in zip(batch.column("bucket").to_pylist(), lists):
            if bucket != here:
                known, here = {}, bucket
            new = [w for w in words if w not in known]
            known.update(zip(new, encoder.encode_words(new)))
            found.append([known[w] for w in words])
        yield batch_of(
            _ANSWERS,
            batch.column("batch"),
            batch.column("codes"),
            [_packed(np.array([len(i) // 4 for i in ids])) for ids in found],
            [_packed(np.frombuffer(b"".join(ids), "<u4")) for ids in found],
        )


def pieces_of(shared) -> pa.Array:
    """The id-to-piece table: the piece of each id and a blank. Its size is that of the vocabulary."""
    held = shared.value
    if "pieces" not in held:
        tokenizer = encoder_of(shared).tokenizer
        if tokenizer.decoder is not None:
            raise ValueError("pieces are joined by blanks, which holds for a tokenizer without decoder")
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            table[number] = piece.encode("utf-8") + b" "
        held["pieces"] = pa.array(table, pa.large_binary())
    return held["pieces"]


def _ends(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]


def _joined(batches: pa.Table, answers: pa.Table, shared, with_ids: bool) -> pa.Table:
    """Ids and decoded text of each document of one batch."""
    sizes_of, codes_of = (_unpacked(batches.column(c)[0].as_py()) for c in ("sizes", "codes"))
    ends = np.concatenate([[0], np.cumsum(sizes_of.astype(np.int64))])
    lists = answers.select(["codes", "sizes", "ids"]).to_pylist()
    empty = [np.empty(0, "<u4")]
    numbers = np.concatenate([np.cumsum(_unpacked(a["codes"])) for a in lists] or empty)
    sizes = np.concatenate([_unpacked(a["sizes"]) for a in lists] or empty)
    place = np.empty(len(numbers), np.int64)
    place[numbers] = np.arange(len(numbers))
    pool = pa.py_buffer(b"".join(_unpacked(a["ids"]).tobytes() for a in lists))
    starts = np.concatenate([[0], 4 * np.cumsum(sizes.astype(np.int64))])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(numbers), [None, pa.py_buffer(starts), pool])
    taken = words.take(pa.array(place[codes_of] if len(numbers) else np.empty(0, np.int64)))
    ids = np.frombuffer(taken.buffers()[2] or b"", "<u4")
    tokens = _ends(taken)[ends] // 4 if len(taken) else np.zeros(len(ends), np.int64)
    table = pieces_of(shared).take(pa.array(ids))
    text = memoryview(table.buffers()[2] or b"")
    bytes_at = _ends(table)[tokens] if len(table) else np.zeros(len(ends), np.int64)
    columns = [
        batches.column("doc_ids")[0].values,
        pa.array(np.diff(tokens), pa.int64()),
        pa.array([hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(tokens[:-1], tokens[1:])]),
        pa.array([hashlib.sha256(text[a : max(a, b - 1)]).hexdigest() for a, b in zip(bytes_at[:-1], bytes_at[1:])]),
    ]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in zip(tokens[:-1], tokens[1:])], pa.list_(pa.int32())))
        columns.append(pa.array([str(text[a : max(a, b - 1)], "utf-8") for a, b in zip(bytes_at[:-1], bytes_at[1:])]))
        names += ["ids", "decoded"]
    return pa.Table.from_arrays(columns, names=names)


def round_trip(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, with_ids: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row (and ``ids``, ``decoded`` on request).

    ``tokenizer`` is the path of a tokenizer file on the driver. Ids are those
    of the library without special tokens added; the decoded text is all pieces
    joined by blanks. A null or empty text has no ids and decodes to nothing;
    repeated rows are encoded alike; an empty table gives an empty result. Words
    are dealt to ``buckets``, by default a number that grows with the square root of
    the rows, as both the rows of a bucket and the buckets of a batch are then few
    enough. The input is read and split once: word lists and documents come from
    one and the same exchange, so rows may arrive in any order.
    """
    if buckets is None:
        buckets = max(64, int(df.count() ** 0.5 / 8))
    shared = shipped(df.sparkSession, tokenizer)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = type_of(df, id_col)
    made = rows.mapInArrow(_batches, f"batch long, doc_ids array<{kind}>, sizes binary, codes binary, words binary")
    coded = made.repartition(buckets, "batch")
    lists = coded.mapInArrow(
        lambda batches: _word_lists(batches, buckets), "bucket long, batch long, codes binary, words binary"
    )
    answers = lists.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda batches: _answers(batches, shared), "batch long, codes binary, sizes binary, ids binary"
    )
    extra = ", ids array<int>, decoded string" if with_ids else ""
    return (
        coded.groupBy("batch")
        .cogroup(answers.repartition(buckets, "batch").groupBy("batch"))
        .applyInArrow(
            lambda left, right: _joined(left, right, shared, with_ids),
            f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}",
        )
    )
