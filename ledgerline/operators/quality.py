"""Grain, enum and null checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys that repeat, rows with a null key part."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("n_repeated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("_n"))), F.lit(0)).alias("n_null_key_rows"),
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats; reads at most one offending key back."""
    found = duplicate_keys(df, keys).first()
    if found is not None:
        raise ValueError(f"key {tuple(keys)} is not unique, e.g. {found.asDict()}")


def outside_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values not in the allowed list with their row counts; null is reported too."""
    bad = F.col(column).isNull() | ~F.col(column).isin(*allowed)
    return (
        df.filter(bad)
        .groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("bad_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def null_counts(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """One row per column: null count and whether the not-null contract holds."""
    columns = [*required, *optional]
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("n_nulls"),
            (F.lit(c in optional) | (F.col(c) == 0)).alias("is_ok"),
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def enforce_not_null(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail the job on the first null in a required column, as a typed read would."""
    checked = [
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in required column {c}"))).otherwise(F.col(c)).alias(c)
        if c in required
        else F.col(c)
        for c in df.columns
    ]
    return df.select(*checked)


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the shape of ``schema``: its columns by name, cast, required ones enforced."""
    required = [f.name for f in schema.fields if not f.nullable]
    picked = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return enforce_not_null(picked, required)
