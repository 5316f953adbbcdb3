from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """All rows as sorted tuples."""
    names = columns or tuple(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def as_set(values) -> list[tuple]:
    return sorted((tuple(v) for v in values), key=repr)


def settled(df: DataFrame) -> DataFrame:
    """The rows alone, as a job would find them stored by the step before."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
