"""Experiment cells, exposure read-outs and allocation checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_percent
from ledgerline.functions.distributions import chi_square_p, normal_p, student_p, student_quantile


def assign_cells(
    users: DataFrame, unit: str, salt: str, cells: Sequence[tuple[str, int]], default: str, name: str = "cell"
) -> DataFrame:
    """Cell of each unit from its hash slot; shares are percents, the rest gets ``default``."""
    slot = hash_percent(salt, F.col(unit))
    label: Column = F.lit(default)
    bound = sum(share for _, share in cells)
    if bound > 100:
        raise ValueError("shares add up to more than 100")
    for cell, share in reversed(list(cells)):
        label = F.when(slot < bound, F.lit(cell)).otherwise(label)
        bound -= share
    return users.withColumn(name, label)


def cell_parity(df: DataFrame, cell: str, even_cells: Sequence[str], name: str = "parity") -> DataFrame:
    """Which parity of item ids a cell sees: 0 for the even cells, else 1."""
    return df.withColumn(name, F.when(F.col(cell).isin(*even_cells), 0).otherwise(1))


def visible_items(cells: DataFrame, items: DataFrame, item: str, cell: str, parity: str = "parity") -> DataFrame:
    """How many items each cell sees under its parity; items are counted before the join."""
    seen = items.groupBy(F.pmod(F.col(item), F.lit(2)).cast("int").alias(parity)).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    return cells.select(cell, parity).distinct().join(seen, parity, "left").select(
        cell, parity, F.coalesce("n_items", F.lit(0)).alias("n_items")
    )


def unit_outcomes(exposures: DataFrame, outcomes: DataFrame, unit: str, time: str, value: str) -> DataFrame:
    """Per exposed unit: outcomes after its first exposure and their total value.

    Outcomes are added up per unit and time before the join.
    """
    first = exposures.groupBy(unit).agg(F.min(time).alias("exposed_at"))
    later = outcomes.groupBy(unit, F.col(time).alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_value")
    )
    joined = first.join(later, unit, "left")
    after = F.col("_at") > F.col("exposed_at")
    return joined.groupBy(unit, "exposed_at").agg(
        F.coalesce(F.sum(F.when(after, F.col("_n"))), F.lit(0)).alias("n_outcomes"),
        F.coalesce(F.sum(F.when(after, F.col("_value"))), F.lit(0)).alias("value"),
    )


def conversion(units: DataFrame, cell: str, converted: Column) -> DataFrame:
    """Exposed, converted and the conversion rate per cell."""
    return (
        units.groupBy(cell)
        .agg(F.count(F.lit(1)).alias("n_exposed"), F.count_if(converted).alias("n_converted"))
        .withColumn("rate", F.col("n_converted") / F.col("n_exposed"))
    )


def readouts(
    units: DataFrame, cell: str, control: str, treatment: str, metrics: Sequence[tuple[str, str]], level: float = 0.95
) -> DataFrame:
    """Means, variances and Welch's t between two cells, one row per (metric, kind); units are read once.

    ``p_value`` is two-sided, ``low`` and ``high`` bound the difference at ``level``.
    """
    stats, entries = [], []
    for i, (metric, kind) in enumerate(metrics):
        x = F.col(metric).cast("double")
        fields = [F.lit(metric).alias("metric"), F.lit(kind).alias("kind")]
        for tag, label in (("control", control), ("treatment", treatment)):
            own = F.when(F.col(cell) == label, x)
            for name, value in (("n", F.count(own)), ("mean", F.avg(own)), ("var", F.var_samp(own))):
                stats.append(value.alias(f"{name}_{tag}_{i}"))
                fields.append(F.col(f"{name}_{tag}_{i}").alias(f"{name}_{tag}"))
        entries.append(F.struct(*fields))
    rows = units.agg(*stats).select(F.inline(F.array(*entries)))
    lift = F.col("mean_treatment") - F.col("mean_control")
    part_c = F.try_divide(F.col("var_control"), F.col("n_control"))
    part_t = F.try_divide(F.col("var_treatment"), F.col("n_treatment"))
    spread = part_c + part_t
    freedom = F.try_divide(
        spread * spread,
        F.try_divide(part_c * part_c, F.col("n_control") - 1) + F.try_divide(part_t * part_t, F.col("n_treatment") - 1),
    )
    tested = rows.select(
        "*", lift.alias("difference"), F.try_divide(lift, F.sqrt(spread)).alias("t_value"), freedom.alias("degrees")
    )
    reach = student_quantile(level, F.col("degrees")) * F.sqrt(spread)
    return tested.select(
        "*",
        student_p(F.col("t_value"), F.col("degrees")).alias("p_value"),
        (F.col("difference") - reach).alias("low"),
        (F.col("difference") + reach).alias("high"),
    )


def readout(units: DataFrame, cell: str, control: str, treatment: str, metric: str, kind: str) -> DataFrame:
    """``readouts`` of one metric."""
    return readouts(units, cell, control, treatment, [(metric, kind)])


def proportion_test(units: DataFrame, cell: str, control: str, treatment: str, hit: Column, name: str) -> DataFrame:
    """Two-proportion z with pooled variance between two cells and its two-sided p-value, as one row."""
    aggs = []
    for tag, label in (("control", control), ("treatment", treatment)):
        own = F.col(cell) == label
        aggs += [F.count_if(own).alias(f"n_{tag}"), F.count_if(own & hit).alias(f"hits_{tag}")]
    row = units.agg(*aggs)
    n_c, n_t = F.col("n_control"), F.col("n_treatment")
    p_c, p_t = F.try_divide(F.col("hits_control"), n_c), F.try_divide(F.col("hits_treatment"), n_t)
    pooled = F.try_divide(F.col("hits_control") + F.col("hits_treatment"), n_c + n_t)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_c) + F.try_divide(F.lit(1.0), n_t)))
    tested = row.select(
        F.lit(name).alias("metric"),
        "n_control",
        "hits_control",
        "n_treatment",
        "hits_treatment",
        (p_t - p_c).alias("difference"),
        F.try_divide(p_t - p_c, error).alias("z_value"),
    )
    return tested.withColumn("p_value", normal_p(F.col("z_value")))


def sample_ratio(units: DataFrame, cell: str, planned: Sequence[tuple[str, int]]) -> DataFrame:
    """Observed and planned units per planned cell with its chi-square share, the sum over all cells and its p-value.

    Rows start from the plan, so a cell that got no unit is there with 0.
    """
    entries = [F.struct(F.lit(c).alias("_cell"), F.lit(n).cast("long").alias("_share")) for c, n in planned]
    plan = units.sparkSession.range(1).select(F.inline(F.array(*entries)))
    counts = units.groupBy(F.col(cell).alias("_cell")).agg(F.count(F.lit(1)).alias("observed"))
    rows = plan.join(counts, "_cell", "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    whole = Window.partitionBy(F.lit(1))  # one row per planned cell
    expected = F.sum("observed").over(whole) * F.col("_share") / F.sum("_share").over(whole)
    scored = rows.select(F.col("_cell").alias(cell), "observed", expected.alias("expected"))
    gap = F.col("observed") - F.col("expected")
    scored = scored.withColumn("chi_square", F.try_divide(gap * gap, F.col("expected")))
    scored = scored.withColumn("chi_square_total", F.sum("chi_square").over(whole))
    return scored.withColumn("p_value", chi_square_p(F.col("chi_square_total"), F.lit(len(planned) - 1)))
