"""Quality rules with risk-controlled cutoffs; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.distributions import incomplete_beta
from ledgerline.llm.common import WORD_GAP, let, staged

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Reject when ``value`` is above the cutoff; ``cutoffs`` go from lenient to strict and are set beforehand."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


#: Values are SQL over the metrics. Cutoffs are fixed before any label is seen.
RULES = (
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", (4.0, 2.0, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("upper_share", "n_upper / greatest(n_letters, 1)", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("dup_line_share", "n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeat_word_share", "n_repeat_words / greatest(n_words, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("exclaim_per_word", "n_exclaim / greatest(n_words, 1)", (2.0, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1)),
    Rule("word_length", "word_chars / greatest(n_words, 1)", (40.0, 30.0, 25.0, 20.0, 15.0, 12.0, 10.0)),
)
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds at least twice.

    Windows become 64-bit hashes with their places, sorted so that equal ones
    meet; places of repeated windows p1 < p2 < ... cover 3 words each, less
    what two neighbours share. Sorting keeps a very long text at n log n.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(places, i - 1)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def repeated(ordered: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, twice), lambda x: x["at"]))

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")
            ),
        )

    def count(w: Column) -> Column:
        found = let(F.sort_array(hashed(w)), lambda ordered: let(repeated(ordered), covered))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(found)

    return let(words, count)


def metrics(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", carry: Sequence[str] = ()
) -> DataFrame:
    """Counts per document, from the whole text, without a shuffle; a null text counts as no words.

    ``n_repeat_words`` compares windows by 64-bit hash within one text.
    ``carry`` columns of the row stand last.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("t"), *carry)
    no_gap = F.translate("t", " \t\n\x0b\x0c\r", "")

    def without(chars: str) -> Column:
        return (F.char_length("t") - F.char_length(F.translate("t", chars, ""))).cast("long")

    lines = F.filter(F.split("t", "\n"), lambda line: F.char_length(F.translate(line, " \t\x0b\x0c\r", "")) > 0)
    words = F.array_remove(F.split("t", WORD_GAP + "+"), "")

    def per_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words"))

    def per_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    return rows.select(
        "doc_id",
        "stratum",
        let(words, per_words).alias("w"),
        let(lines, per_lines).alias("l"),
        F.char_length(no_gap).cast("long").alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        without("!").alias("n_exclaim"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz").alias("n_letters"),
        *carry,
    ).select("doc_id", "stratum", "w.*", "l.*", "word_chars", "n_symbols", "n_exclaim", "n_upper", "n_letters", *carry)


def binomial_tail(k: Column, n: Column, risk: Column) -> Column:
    """P(Bin(``n``, ``risk``) <= ``k``), exactly, through the incomplete beta function; its cost does not grow with ``n``."""
    return F.when(k >= n, F.lit(1.0)).otherwise(incomplete_beta(n - k, k + 1, 1 - risk))


def steps_of(rules: Sequence[Rule]) -> list[list[float]]:
    """One path from lenient to strict: the cutoffs of all rules at each step; a shorter rule stays at its last."""
    return [[rule.cutoffs[min(i, len(rule.cutoffs) - 1)] for rule in rules] for i in range(max(len(r.cutoffs) for r in rules))]


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    risk: float = 0.02,
    level: float = 0.05,
    id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """One row per stratum: good documents, the step of the path that is in force, and each rule's cutoff, null where none is safe.

    The holdout is every labelled document; one counts as good if all its labels
    say 1. All rules become stricter together along the path of ``steps_of``, which
    is fixed before any label is seen. At each step the good documents that any
    rule rejects are counted, and the hypothesis that the rules reject ``risk`` or
    more of the stratum's good documents is tested by the exact binomial tail. The
    first step that is not shown safe ends the path, so the path needs no
    correction; over strata ``level`` is divided by their number (Bonferroni).
    Together: with probability 1 - ``level`` no stratum loses more than ``risk`` of
    its good documents to the chosen cutoffs. A stratum with 150 to 220 good
    documents, by the number of strata, can choose at 2 %.
    """
    good = labels.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(F.col(label_col)).alias("quality"))
    good = good.filter("quality = 1").select("doc_id")
    held = measured.join(good, "doc_id").withColumn("stratum", F.coalesce("stratum", F.lit("")))
    steps = steps_of(rules)
    rejected = [reduce(Column.__or__, [F.expr(r.value) > c for r, c in zip(rules, step)]) for step in steps]
    seen = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(x) for x in rejected]).alias("x")
    )
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))  # one row per stratum
    counted = seen.withColumn("level", F.lit(level) / strata)
    safe = F.transform("x", lambda x: binomial_tail(x, F.col("n"), F.lit(risk)) <= F.col("level"))
    ended = F.array_position(F.transform(safe, lambda s: ~s), True)
    chosen = counted.withColumn("step", F.when(ended > 0, ended - 1).otherwise(F.lit(len(steps))).cast("int"))
    table = F.array(*[F.array(*map(F.lit, step)) for step in steps])
    now = F.when(F.col("step") > 0, F.element_at(table, F.greatest("step", F.lit(1))))
    return chosen.select("stratum", F.col("n").alias("n_good"), "step", *[now[i].alias(rule.name) for i, rule in enumerate(rules)])


def assess(
    df: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    risk: float = 0.02,
    level: float = 0.05,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Metrics, ``base_failed``, ``kept`` and ``failed_rules`` for every row of ``df``.

    Texts are read once: their metrics are written to the shared folder, and
    both the cutoffs and the verdicts come from those. A row without text has
    no words and fails the base; a null stratum is a stratum of its own; a
    stratum without enough labels rejects nothing beyond the base. An empty
    table gives an empty result, empty labels leave the base alone. ``carry``
    columns of the row come along.
    """
    measured = staged(metrics(df, id_col, text_col, stratum_col, carry), "quality")
    chosen = cutoffs(measured, labels, rules, risk, level).drop("n_good", "step")
    rows = measured.withColumn("stratum", F.coalesce("stratum", F.lit(""))).join(chosen, "stratum", "left")
    failed = F.array(
        *[F.when(F.expr(rule.value) > F.col(rule.name), F.lit(rule.name)) for rule in rules]
    )
    base = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    return rows.select(
        "doc_id", *carry, *METRICS, base.alias("base_failed"), F.array_join(F.array_compact(failed), ",").alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
