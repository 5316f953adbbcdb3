"""Registered queries on given tables: SQL where there is some, contract columns everywhere."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from ledgerline.llm import catalog, oracles, quality  # noqa: E402

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op2": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3": "doc_id bigint, fingerprint string, component_id bigint",
    "op4": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op5": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6": "doc_id bigint, score double",
    "op7": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op9": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op11": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op12": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


def test_every_operator_has_one_query():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_columns(spark, small, name):
    types = dict(catalog.QUERIES[name](spark, small).dtypes)
    want = dict(c.split() for c in COLUMNS[name.split("_")[0]].split(", "))
    assert {c: types.get(c) for c in want} == want


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    good, note = compare.compare(spark, compare.connect(SF), SF, name, catalog.QUERIES[name], catalog.SQL[name])
    assert good, note


def test_quality_sql_with_other_risks(spark):
    def run(spark, sf_dir):
        docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
        return quality.assess(docs, labels, risk=0.3, level=0.2)

    good, note = compare.compare(spark, compare.connect(SF), SF, "quality", run, oracles.quality_rules(0.3, 0.2))
    assert good, note


def test_cutoffs_are_in_force_in_the_query(spark):
    got = catalog.op2_quality_rules(spark, SF)
    assert got.filter("failed_rules <> '' and not base_failed").count() > 0
    assert got.filter("not kept and not base_failed").count() < 0.2 * got.count()
