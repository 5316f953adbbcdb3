"""Assignment, exposures and read-outs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.operators import experiments

SALT = "signup_button"
CELLS = (("control", 45), ("treatment", 45))
DEFAULT = "unassigned"
SLOT = f"CAST(('0x' || substr(md5('{SALT}:' || user_id), 1, 8)) AS BIGINT) % 100"
CELL = f"CASE WHEN {SLOT} < 45 THEN 'control' WHEN {SLOT} < 90 THEN 'treatment' ELSE 'unassigned' END"
EXPOSED = f"""(SELECT *, {CELL} AS cell FROM (
            SELECT f.user_id, f.exposed_at, count(p.day) FILTER (p.day > f.exposed_at) AS n_outcomes,
                   CAST(coalesce(sum(p.amount_cents) FILTER (p.day > f.exposed_at), 0) AS BIGINT) AS value
            FROM (SELECT user_id, min(day) AS exposed_at FROM purchases_by_user GROUP BY 1) f
            JOIN purchases_by_user p ON p.user_id = f.user_id GROUP BY 1, 2))"""


def cells(df: DataFrame) -> DataFrame:
    return experiments.assign_cells(df, "user_id", SALT, CELLS, DEFAULT)


def exposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order is the exposure, later orders are the outcomes."""
    orders = views.purchases_by_user(spark, sf_dir)
    return cells(experiments.unit_outcomes(orders, orders, "user_id", "day", "amount_cents"))


@query(
    "e1_assign",
    f"""SELECT user_id, cell, CAST(CASE WHEN cell = 'treatment' THEN 0 ELSE 1 END AS BIGINT) AS parity
        FROM (SELECT user_id, {CELL} AS cell FROM (SELECT c_custkey AS user_id FROM customer))""",
)
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cells(views.users(spark, sf_dir).select("user_id"))
    return experiments.cell_parity(rows, "cell", ["treatment"])


@query(
    "e2_conversion",
    using(
        f"""SELECT cell, count(*) AS n_exposed, count(*) FILTER (n_outcomes > 2) AS n_converted,
            round(CAST(count(*) FILTER (n_outcomes > 2) AS DOUBLE) / count(*), 6) AS rate FROM {EXPOSED} GROUP BY 1""",
        "purchases_by_user",
    ),
)
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user converts by buying more than twice after the first order."""
    return experiments.conversion(exposed(spark, sf_dir), "cell", F.col("n_outcomes") > 2)


def readout_sql(metric: str, kind: str) -> str:
    return f"""SELECT '{metric}' AS metric, '{kind}' AS kind, n_control, mean_control, var_control, n_treatment, mean_treatment,
            var_treatment, mean_treatment - mean_control AS difference,
            (mean_treatment - mean_control) / sqrt(var_control / n_control + var_treatment / n_treatment) AS t_value,
            pow(var_control / n_control + var_treatment / n_treatment, 2)
              / (pow(var_control / n_control, 2) / (n_control - 1) + pow(var_treatment / n_treatment, 2) / (n_treatment - 1)) AS degrees
        FROM (SELECT count(*) FILTER (cell = 'control') AS n_control, avg(x) FILTER (cell = 'control') AS mean_control,
              var_samp(x) FILTER (cell = 'control') AS var_control, count(*) FILTER (cell = 'treatment') AS n_treatment,
              avg(x) FILTER (cell = 'treatment') AS mean_treatment, var_samp(x) FILTER (cell = 'treatment') AS var_treatment
              FROM (SELECT cell, CAST({metric} AS DOUBLE) AS x FROM exposed))"""


NUMBERS = (
    "mean_control", "var_control", "mean_treatment", "var_treatment", "difference", "t_value", "degrees", "p_value", "low", "high",
)


def half_mass(t: str, degrees: str) -> str:
    """The mass of Student's density from 0 to ``t`` by Simpson's rule, another way than the operator's."""
    density = f"exp(-({degrees} + 1) / 2 * ln(1 + pow({t} * k / 400.0, 2) / {degrees}))"
    weighed = f"list_sum([(CASE WHEN k IN (0, 400) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * {density} FOR k IN range(401)])"
    return f"{weighed} * {t} / 1200.0 * {peak(degrees)}"


def peak(degrees: str) -> str:
    return f"exp(lgamma(({degrees} + 1) / 2) - lgamma({degrees} / 2)) / sqrt({degrees} * pi())"


#: Newton's steps to the t that leaves 5 % in both tails.
CRITICAL = f"""(WITH RECURSIVE steps AS (SELECT metric, degrees, 1.96::DOUBLE AS t, 0 AS i FROM tested
            UNION ALL SELECT metric, degrees, t - ({half_mass("t", "degrees")} - 0.475)
                / ({peak("degrees")} * exp(-(degrees + 1) / 2 * ln(1 + t * t / degrees))), i + 1 FROM steps WHERE i < 6)
        SELECT metric, t AS critical FROM steps WHERE i = 6)"""


@query(
    "e3_readout",
    using(
        "SELECT metric, kind, n_control, n_treatment, "
        + ", ".join(f"round({c}, 4) AS {c}" for c in NUMBERS)
        + f" FROM (WITH exposed AS (SELECT user_id, cell, n_outcomes, value // 1000000 AS spend FROM {EXPOSED}), "
        + f"tested AS ({readout_sql('n_outcomes', 'leading')} UNION ALL {readout_sql('spend', 'lagging')}) "
        + f"SELECT tested.*, 1 - 2 * {half_mass('abs(t_value)', 'degrees')} AS p_value, "
        + "difference - critical * abs(difference / t_value) AS low, difference + critical * abs(difference / t_value) AS high "
        + f"FROM tested JOIN {CRITICAL} c USING (metric))",
        "purchases_by_user",
    ),
)
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders lead, spend (in ten thousands) lags."""
    units = exposed(spark, sf_dir).withColumn("spend", F.floor(F.col("value") / 1000000))
    both = experiments.readouts(units, "cell", "control", "treatment", [("n_outcomes", "leading"), ("spend", "lagging")])
    return both.select("metric", "kind", "n_control", "n_treatment", *[F.round(c, 4).alias(c) for c in NUMBERS])


@query(
    "e3_proportion",
    using(
        f"""SELECT 'repeat_buyer' AS metric, n_control, hits_control, n_treatment, hits_treatment,
            round(pt - pc, 6) AS difference,
            round(z, 6) AS z_value, round(1 - 2 / sqrt(2 * pi()) * abs(z) / 1200.0 * list_sum([(CASE WHEN k IN (0, 400) THEN 1
                WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(z * k / 400.0, 2) / 2) FOR k IN range(401)]), 6) AS p_value
        FROM (SELECT *, (pt - pc) / sqrt(p * (1 - p) * (1.0::DOUBLE / n_control + 1.0::DOUBLE / n_treatment)) AS z FROM (SELECT *, CAST(hits_control AS DOUBLE) / n_control AS pc, CAST(hits_treatment AS DOUBLE) / n_treatment AS pt,
                     CAST(hits_control + hits_treatment AS DOUBLE) / (n_control + n_treatment) AS p
              FROM (SELECT count(*) FILTER (cell = 'control') AS n_control,
                           count(*) FILTER (cell = 'control' AND n_outcomes > 2) AS hits_control,
                           count(*) FILTER (cell = 'treatment') AS n_treatment,
                           count(*) FILTER (cell = 'treatment' AND n_outcomes > 2) AS hits_treatment FROM {EXPOSED})))""",
        "purchases_by_user",
    ),
)
def e3_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = exposed(spark, sf_dir)
    return experiments.proportion_test(units, "cell", "control", "treatment", F.col("n_outcomes") > 2, "repeat_buyer")


@query(
    "e4_srm",
    using(
        f"""SELECT cell, observed, expected, round(x, 6) AS chi_square, round(s, 6) AS chi_square_total,
            round(1 - 2 / sqrt(2 * pi()) * sqrt(s) / 1200.0 * list_sum([(CASE WHEN k IN (0, 400) THEN 1
                WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-s * pow(k / 400.0, 2) / 2) FOR k IN range(401)]), 6) AS p_value
        FROM (SELECT *, sum(x) OVER () AS s FROM (SELECT *, (observed - expected) * (observed - expected) / expected AS x
              FROM (SELECT p.cell, count(u.cell) AS observed, CAST(sum(count(u.cell)) OVER () AS DOUBLE) * share / sum(share) OVER () AS expected
                    FROM (VALUES ('control', 45), ('treatment', 45)) p(cell, share) LEFT JOIN {EXPOSED} u ON u.cell = p.cell
                    GROUP BY p.cell, share)))""",
        "purchases_by_user",
    ),
)
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.sample_ratio(exposed(spark, sf_dir), "cell", CELLS)


@query(
    "e5_parity_items",
    f"""SELECT cell, CAST(parity AS BIGINT) AS parity, (SELECT count(*) FROM part WHERE p_partkey % 2 = parity) AS n_items
        FROM (SELECT DISTINCT cell, CASE WHEN cell = 'treatment' THEN 0 ELSE 1 END AS parity
              FROM (SELECT {CELL} AS cell FROM (SELECT c_custkey AS user_id FROM customer)))""",
)
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = experiments.cell_parity(cells(views.users(spark, sf_dir)), "cell", ["treatment"])
    return experiments.visible_items(rows, views.devices(spark, sf_dir), "device_id", "cell")
