"""Reading the snapshot that a daily or yearly step continues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_before(prev: DataFrame, column: str, before: object) -> DataFrame:
    """The rows of ``prev`` whose ``column`` is ``before``.

    ``prev`` may be one snapshot or a stored table of many; only that partition
    is read, to see when the step is built whether it has a row and when the step
    runs. If it has none, ``prev`` must be empty, which makes a first step: else
    the snapshot that the step continues is missing, which is an error.
    """
    found = prev.filter(F.col(column) == F.lit(before))
    if found.isEmpty():
        latest = prev.agg(F.max(column)).first()[0]
        if latest is not None:
            raise ValueError(f"needs the snapshot of {before}, the latest is {latest}")
    return found
