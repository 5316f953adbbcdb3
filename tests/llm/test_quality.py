from __future__ import annotations

from math import comb

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import quality

PART = st.sampled_from(["a", "b", "c", "#x", "é!", "\n", "\n\n", " ", "\t", "d"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(PART, max_size=40).map(" ".join), min_size=30, max_size=60))
def test_metrics(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = quality.metrics(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id: tuple(r[m] for m in quality.METRICS) for r in got} == {
        i: brute.quality_metrics(t) for i, t in enumerate(texts)
    }


@pytest.mark.parametrize(("n", "risk"), [(1, 0.1), (10, 0.1), (200, 0.05), (3000, 0.02)])
def test_binomial_tail(spark, n, risk):
    total, want = 0.0, []
    for k in range(min(n, 80) + 1):
        total += comb(n, k) * risk**k * (1 - risk) ** (n - k)
        want.append(total)
    got = spark.range(len(want)).select(quality.binomial_tail(F.col("id"), F.lit(n), F.lit(risk)).alias("p"), "id").collect()
    assert [r.p for r in sorted(got, key=lambda r: r.id)] == pytest.approx(want, rel=1e-9)


def test_binomial_tail_of_many(spark):
    p = spark.range(1).select(quality.binomial_tail(F.lit(49_000_000), F.lit(1_000_000_000), F.lit(0.05)).alias("p")).first()["p"]
    assert 0 <= p < 1e-100


RULE = (quality.Rule("symbols", "n_symbols / greatest(n_words, 1)", (3.0, 2.0, 1.0, 0.0)),)


def test_cutoffs_keep_to_the_risk(spark):
    # of 1000 good documents 10 have a ratio above 2 and 200 above 1
    text = lambda i: " ".join(["###" if i < 10 else "##" if i < 200 else "a"] * 60)
    rows = [(i, text(i), "en") for i in range(1000)] + [(5000, text(0), "de"), (5001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(1000)] + [(1000, 0), (5000, 1)], "doc_id long, quality int")
    measured = quality.metrics(docs)
    chosen = {r.stratum: (r.symbols, r.step) for r in quality.cutoffs(measured, labels, RULE, 0.05, 0.05).collect()}
    assert chosen == {"en": (2.0, 2), "de": (None, 0)}
    kept = {r.doc_id: r for r in quality.assess(docs, labels, RULE, 0.05, 0.05).collect()}
    assert kept[0].base_failed and kept[5000].failed_rules == "" and kept[0].failed_rules == "symbols"


TWO = (*RULE, quality.Rule("lines", "n_dup_lines / greatest(n_lines, 1)", (0.9, 0.5)))


def test_rules_share_one_risk(spark):
    """Each rule alone rejects little at its second step, both together too much: neither goes further than the first."""
    rows = [(i, "## " * 60 if i < 6 else "a\n" * 60 if i < 12 else "# a" if i < 72 else "b", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    first = quality.cutoffs(quality.metrics(docs), labels, RULE, 0.05, 0.05).first()
    both = quality.cutoffs(quality.metrics(docs), labels, TWO, 0.05, 0.05).first()
    assert (first.step, first.symbols) == (3, 1.0)
    assert (both.step, both.symbols, both.lines) == (2, 2.0, 0.5)
    assert quality.steps_of(TWO) == [[3.0, 0.9], [2.0, 0.5], [1.0, 0.5], [0.0, 0.5]]


@pytest.mark.parametrize(("n", "strata", "chosen"), [(148, 1, 0), (149, 1, 1), (216, 4, 0), (217, 4, 1)])
def test_few_labels_are_enough(spark, n, strata, chosen):
    """Without any false rejection the first step is safe from log(level) / log(1 - risk) good documents on."""
    rows = [(1000 * s + i, "a b c", f"s{s}") for s in range(strata) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    steps = {r.step for r in quality.cutoffs(quality.metrics(docs), labels, RULE, 0.02, 0.05).collect()}
    assert steps == ({4} if chosen else {0})


def test_conflicting_labels_do_not_count_as_good(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    assert quality.cutoffs(quality.metrics(docs), labels).collect() == []


def test_odd_rows(odd, no_labels):
    got = quality.assess(odd, no_labels).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept
    assert by_id[6].n_words == 30_000 and by_id[6].n_repeat_words > 15_000
    assert not any(r.failed_rules for r in got)


def test_empty_table(none, no_labels):
    assert quality.assess(none, no_labels).collect() == []


def test_native(docs, no_labels):
    from ledgerline.plans import inspect

    assert not inspect.uses_python(quality.assess(docs, no_labels))
