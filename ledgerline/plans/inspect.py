"""What a DataFrame will do, read from its physical plan."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """The plan before execution; adaptive plans show their initial form."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, pattern: str) -> int:
    return len(re.findall(pattern, plan_text(df)))


def shuffles(df: DataFrame) -> int:
    """Exchanges that move rows between tasks by key, range or round robin."""
    return count_nodes(df, r"Exchange (?:hash|range|Round)")


def broadcasts(df: DataFrame) -> int:
    return count_nodes(df, r"BroadcastHashJoin|BroadcastNestedLoopJoin")


def has_cross_join(df: DataFrame) -> bool:
    return bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan_text(df)))


def uses_python(df: DataFrame) -> bool:
    return bool(re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan_text(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^\n]*)>", plan_text(df))
