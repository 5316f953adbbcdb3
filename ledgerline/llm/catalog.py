"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    bpe, langid, licenses, lm, oracles, packing, prefixes, quality, sharding, simhash, spelling, substrings, vectors, warc,
)
from ledgerline.llm.common import documents

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.assess(documents(spark, sf_dir), labels)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, limit=4)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(documents(spark, sf_dir))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return lm.cross_entropy_difference(documents(spark, sf_dir), labels.filter("quality = 1 and toxic = 0"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_path())


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_quality_rules, op3_simhash_dedup, op4_substring_dedup, op5_sharding, op6_lm_scoring,
        op7_language_id, op8_bpe_round_trip, op9_vector_dedup, op10_packing, op11_warc, op12_prefix_trie,
        op13_spelling_variants,
    )
}
SQL: dict[str, str] = dict(oracles.SQL)
