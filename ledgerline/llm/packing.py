"""Packing by powers of two: binary-length pieces, equal lengths together, no sequence across documents."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, numbered, pieces, staged, type_of
from ledgerline.llm.tokens import encoder_of, shipped

END_ID = 2
PIECES_PER_BUCKET = 8192


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as pieces of ``longest`` and then falling powers of two, none twice but ``longest``."""
    out = [longest] * (n // longest)
    rest, size = n % longest, longest // 2
    while rest:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out


def cut(
    df: DataFrame, tokenizer: str, longest: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece with its ids: ``doc_id, start, length, ids, doc_tokens``.

    A document is its ids and then id 2, so a null or empty text is one piece
    of length 1. Whole texts are encoded, however long; ``tokenizer`` is the path
    of a tokenizer file on the driver.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    shared = shipped(df.sparkSession, tokenizer)
    schema = pa.schema(
        [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
    )

    def cut_texts(batches):
        encoder = encoder_of(shared)
        for batch in pieces(batches, 4096, 16 << 20):
            rows, starts, lengths, ids, totals = [], [], [], [], []
            found, ends = encoder.encode_column(batch.column("text"))
            for row in range(batch.num_rows):
                own = found[ends[row] : ends[row + 1]].tobytes() + END_ID.to_bytes(4, "little")
                total, at = len(own) // 4, 0
                for length in binary_lengths(total, longest):
                    rows.append(row)
                    starts.append(at)
                    lengths.append(length)
                    ids.append(own[4 * at : 4 * (at + length)])
                    totals.append(total)
                    at += length
            taken = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            made = batch_of(schema, starts, lengths, ids, totals)
            yield pa.RecordBatch.from_arrays([taken, *made.columns], names=["doc_id", *schema.names])

    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        cut_texts,
        f"doc_id {type_of(df, id_col)}, start long, length long, ids binary, doc_tokens long",
    )


def pack(
    df: DataFrame, tokenizer: str, longest: int = 4096, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence: ``sequence_id``, ``offset``, ``ids_crc32`` (and ``ids`` on request).

    Each piece fills a sequence of its own length, so nothing is padded and no
    sequence crosses documents. Lengths are powers of two; sequences of one
    length are numbered without gaps in hashed order, and ``sequence_id`` is
    number x (log2(longest) + 1) + log2(length). Repeated rows are packed each
    on its own.
    """
    made = cut(df, tokenizer, longest, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    made = staged(made if with_ids else made.drop("ids"), "pieces")
    mixed = F.xxhash64("doc_id", "start", "ids_crc32")
    buckets = max(1, -(-made.count() // PIECES_PER_BUCKET))
    order = [mixed, F.col("doc_id"), F.col("start"), F.col("doc_tokens"), F.col("ids_crc32")]
    ranked = numbered(made, order, F.pmod(mixed, F.lit(buckets)), "_rank", ["length"])
    power = F.log2(F.col("length")).cast("long")
    kept = ("doc_id", "start", "length", "ids_crc32", "doc_tokens") + (("ids",) if with_ids else ())
    return ranked.select(
        *kept, (F.col("_rank") * longest.bit_length() + power).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
