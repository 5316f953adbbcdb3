"""Named queries, each with an independent SQL text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as long, days and times as text: the same in both engines."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _WHOLE):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; ``sql`` must name the same columns."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(run(spark, sf_dir))

        shown.__name__ = name
        shown.__doc__ = run.__doc__
        QUERIES[name] = shown
        if sql is not None:
            SQL[name] = " ".join(sql.split())
        return run

    return register
