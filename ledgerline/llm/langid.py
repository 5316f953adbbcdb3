"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, pieces, type_of

UNKNOWN = "und"
ORDERS = (1, 2, 3)
#: Positions scored at once; bounds a task's memory whatever the length of a text.
CHUNK = 1 << 18
_MIX = np.uint32(0x9E3779B1)


def codes_of(text: str) -> np.ndarray:
    """Lower-cased code points with one blank before and after."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_ids(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hashed id of the n-gram that starts at each place where one fits."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    mixed = np.full(n, order, np.uint32)
    for j in range(order):
        mixed = (mixed ^ codes[j : n + j]) * _MIX
        mixed ^= mixed >> np.uint32(15)
    return (mixed >> np.uint32(32 - bits)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _stretches(codes: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """``codes`` in bounded stretches that overlap, so that each n-gram is seen once."""
    step = CHUNK - order + 1
    for start in range(0, max(1, len(codes) - order + 1), step):
        yield codes[start : start + CHUNK]


def count_grams(texts: list[str], bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, np.int64)
    for text in texts:
        codes = codes_of(text)
        for order in ORDERS:
            for part in _stretches(codes, order):
                out += np.bincount(gram_ids(part, order, bits), minlength=1 << bits)
    return out


def score_texts(texts: list[str], weights: np.ndarray, bits: int) -> np.ndarray:
    """Sum of log-probabilities per text and class.

    Short texts are joined and scored together: each n-gram place is one
    non-zero of the sparse count matrix, its row of ``weights`` is looked up
    and rows are added up per text. Places that cross two texts are looked up
    in an extra row of zeros.
    """
    out = np.zeros((len(texts), weights.shape[1]))
    padded = np.vstack([weights, np.zeros((1, weights.shape[1]), weights.dtype)])
    group: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if not group:
            return
        joined = np.concatenate([codes for _, codes in group])
        ends = np.cumsum([len(codes) for _, codes in group])
        starts = np.concatenate([[0], ends[:-1]])
        rows = [row for row, _ in group]
        for order in ORDERS:
            ids = np.full(len(joined), 1 << bits, np.int64)
            found = gram_ids(joined, order, bits)
            ids[: len(found)] = found
            for back in range(1, order):
                ids[ends - back] = 1 << bits
            out[rows] += np.add.reduceat(padded[ids], starts, axis=0, dtype=np.float64)
        group.clear()

    for row, text in enumerate(texts):
        codes = codes_of(text)
        if len(codes) > CHUNK:
            for order in ORDERS:
                for part in _stretches(codes, order):
                    out[row] += weights[gram_ids(part, order, bits)].sum(axis=0, dtype=np.float64)
            continue
        if size + len(codes) > CHUNK:
            flush()
            size = 0
        group.append((row, codes))
        size += len(codes)
    flush()
    return out


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id alone, never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 15,
    rows_per_lang: int = 20_000,
    smoothing: float = 0.5,
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels, log-probability matrix (2**bits x labels) and log priors.

    Learns from rows that have a text and a label and are not held out. At
    most about ``rows_per_lang`` rows of a label are read, chosen by a hash of
    the id; counts are summed in Spark, so the driver sees no more than
    2**bits counts per label.
    """
    usable = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    if not labels:
        return [], np.zeros((1 << bits, 0), np.float32), np.zeros(0)
    share = F.lit(0.0)
    for lang in labels:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, rows_per_lang / sizes[lang]))).otherwise(share)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = usable.filter(chance < share).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def counted(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in pieces(batches):
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                found = count_grams(some, bits)
                totals[lang] = totals[lang] + found if lang in totals else found
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield batch_of(schema, [lang] * len(seen), seen, total[seen])

    grams = sample.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = np.zeros((1 << bits, len(labels)))
    column = {lang: i for i, lang in enumerate(labels)}
    for row in grams.collect():
        counts[row["gram"], column[row["lang"]]] = row["n"]
    logs = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * (1 << bits)))
    rows = np.array([sizes[lang] for lang in labels], float)
    return labels, logs.astype(np.float32), np.log(rows / rows.sum())


def predict(
    df: DataFrame,
    model: tuple[list[str], np.ndarray, np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` (posterior of the class) for every row; ``carry`` columns follow.

    A null text or one without a letter is ``und`` with score 0, and so is
    every text when nothing could be learnt. Repeated rows are scored alike;
    equal posteriors go to the first label in alphabetical order.
    """
    labels, weights, prior = model
    bits = int(weights.shape[0]).bit_length() - 1
    shared = df.sparkSession.sparkContext.broadcast((labels, weights, prior))
    source = df.select(F.col(id_col), F.col(text_col).alias("_text"), *carry)
    kept = [id_col, *carry]
    names = ", ".join(f"`{c}` {type_of(df, c)}" for c in kept)

    def scored(batches):
        labels, weights, prior = shared.value
        for batch in pieces(batches):
            texts = batch.column("_text").to_pylist()
            known = [i for i, text in enumerate(texts) if labels and has_letter(text)]
            langs, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                total = score_texts([texts[i] for i in known], weights, bits) + prior
                top = total.argmax(axis=1)
                total -= total.max(axis=1, keepdims=True)
                best[known] = 1.0 / np.exp(total).sum(axis=1)
                for i, k in zip(known, top):
                    langs[i] = labels[k]
            columns = [batch.column(c) for c in kept] + [pa.array(langs, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    return source.mapInArrow(scored, f"{names}, lang_pred string, score double")


def identify(df: DataFrame, **options) -> DataFrame:
    """Fit on ``df`` and predict every row of it: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    out = predict(df, fit(df, **options))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
