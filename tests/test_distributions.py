"""Tail probabilities against printed tables and numeric integrals."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import distributions as d


def values(spark, data, schema, column):
    return [r["x"] for r in spark.createDataFrame(data, schema).select(column.alias("x")).collect()]


def integral(density, low, high, steps=20_000):
    """Simpson's rule."""
    h = (high - low) / steps
    inner = sum((4 if i % 2 else 2) * density(low + i * h) for i in range(1, steps))
    return (density(low) + inner + density(high)) * h / 3


def student(v):
    scale = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    return lambda u: scale * math.exp(-(v + 1) / 2 * math.log1p(u * u / v))


def test_log_gamma(spark):
    data = [(z,) for z in (0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 12345.5, 5e8)]
    for (z,), got in zip(data, values(spark, data, "z double", d.log_gamma(F.col("z")))):
        assert got == pytest.approx(math.lgamma(z), rel=1e-12, abs=1e-11)


def test_student_p(spark):
    data = [(t, v) for v in (1.0, 2.0, 3.7, 10.0, 30.0, 400.0, 1e5, 1e7) for t in (0.0, 0.01, -0.7, 1.3, 1.96, 2.6, 5.0)]
    for (t, v), got in zip(data, values(spark, data, "t double, v double", d.student_p(F.col("t"), F.col("v")))):
        assert got == pytest.approx(1 - 2 * integral(student(v), 0, abs(t)), abs=2e-8)


def test_printed_tables(spark):
    t = F.col("t"), F.col("v")
    assert values(spark, [(2.228139, 10.0), (12.706205, 1.0), (63.656741, 1.0)], "t double, v double", d.student_p(*t)) == pytest.approx([0.05, 0.05, 0.01], abs=1e-6)
    chi = [(3.841459, 1), (5.991465, 2), (18.307038, 10), (0.004, 1), (29.588298, 10)]
    got = values(spark, chi, "t double, v int", d.chi_square_p(*t))
    assert got == pytest.approx([0.05, 0.05, 0.05, 0.949571, 0.001], abs=1e-6)
    assert values(spark, [(1.959964,), (-2.575829,), (0.0,), (6.0,)], "t double", d.normal_p(F.col("t"))) == pytest.approx([0.05, 0.01, 1.0, 1.973175e-9], abs=1e-6)


def test_normal_p_is_erfc(spark):
    data = [(z / 7,) for z in range(-60, 61)]
    for (z,), got in zip(data, values(spark, data, "z double", d.normal_p(F.col("z")))):
        assert got == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-10)


def test_student_quantile(spark):
    data = [(1.0,), (2.0,), (10.0,), (30.0,), (120.0,), (1e6,)]
    got = values(spark, data, "v double", d.student_quantile(0.95, F.col("v")))
    assert got == pytest.approx([12.706205, 4.302653, 2.228139, 2.042272, 1.979930, 1.959966], abs=2e-6)


def test_nothing_known_gives_null(spark):
    data = [(None, 3.0), (1.0, None), (1.0, 0.0)]
    t = F.col("t"), F.col("v")
    for column in (d.student_p(*t), d.chi_square_p(*t), d.student_quantile(0.95, F.when(t[0].isNotNull(), t[1]))):
        assert values(spark, data, "t double, v double", column) == [None, None, None]
    assert values(spark, [(None,)], "t double", d.normal_p(F.col("t"))) == [None]
