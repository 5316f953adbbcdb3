"""From raw documents to packed sequences in five stages, each one operator of ``ledgerline.llm``.

Every stage reads what the stage before it wrote and keeps the columns of
``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import langid, packing, quality, simhash, substrings
from ledgerline.llm.catalog import tokenizer_path
from ledgerline.llm.common import documents, staged

#: A language is taken as recognised from this posterior on.
LEAST_SCORE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_print(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` and ``_row``, a hash of all but the id: ids may be null or repeat."""
    apart = [x for c in COLUMNS[1:] for x in (F.col(c), F.lit(0))]
    return docs.select(*COLUMNS).withColumn("_row", F.xxhash64(*apart))


def these(rows: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """The ``rows`` whose id, null or not, and print are among ``chosen``."""
    same = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r._row") == F.col("c._row"))
    return rows.alias("r").join(chosen.alias("c"), same, how).select(*[f"r.{c}" for c in rows.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or with no clear language go."""
    rows = docs.select(*COLUMNS)
    seen = langid.predict(rows, langid.fit(rows), carry=COLUMNS[1:])
    return seen.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, each row by its own text, with or without an id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = with_print(docs)
    verdicts = quality.assess(rows, labels, carry=("_row",)).filter("kept").select("doc_id", "_row")
    return these(rows, verdicts, "left_semi").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id.

    Rows without id come after all others; of rows that share the id the
    smallest hash decides, and of equal rows one stays.
    """
    rows = with_print(docs)
    groups = simhash.near_duplicates(rows, shingle=4, limit=4, carry=("_row",), group="_group")
    copies = groups.groupBy("_group", "doc_id", "_row").agg(F.count(F.lit(1)).alias("n"))
    first = copies.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "n")).alias("f"))
    first = staged(first.select("f.doc_id", "f._row", "f.n"), "first")
    one = these(rows, first.filter("n = 1"), "left_semi")
    equal = these(rows, first.filter("n > 1"), "left_semi").dropDuplicates(["doc_id", "_row"])
    return one.unionByName(equal).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that stand in an earlier one; a document left without words goes."""
    cut = substrings.remove_repeats(docs, with_text=True, carry=("lang", "source", "n_chars"))
    kept = cut.filter("n_words > n_removed")
    chars = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", chars.alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids (little-endian, 32 bits), each in a sequence of its own."""
    return packing.pack(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language ID", language),
    ("quality rules", clean),
    ("SimHash near-dedup", distinct),
    ("substring dedup", without_repeats),
    ("packing", packed),
]

#: Fitted models, fingerprints and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{k}")
    return docs
