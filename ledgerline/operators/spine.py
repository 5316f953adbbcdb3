"""Entity-by-period rows without a join against a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def period_spine(
    rows: DataFrame,
    keys: Sequence[str],
    period: str,
    last: Column,
    entry: Sequence[Column] = (),
    statics: Sequence[Column] = (),
    only_last: bool = False,
) -> DataFrame:
    """Every key in every period from its first one to ``last``, or just in ``last``.

    ``rows`` must be unique on (keys, period), so the array kept per key is no
    longer than the calendar. One shuffle by key; the gaps between two
    neighbouring entries are then filled within the row.

    Adds ``_all`` (entries in order, each with its period ``_p``), ``_first``
    (the first period), ``_i`` (index of the latest entry), ``_now`` and
    ``_before`` (latest entry and the one before it) and ``is_active`` (the
    period has an entry of its own). A caller that does not read ``_all`` does
    not carry it into the filled rows.
    """
    is_date = isinstance(rows.schema[period].dataType, T.DateType)
    stamped = F.struct(F.col(period).alias("_p"), *entry)
    packed = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(stamped)).alias("_all"), *statics
    )
    first = F.get("_all", F.lit(0))["_p"].alias("_first")
    before = F.get("_all", F.col("_i") - 1).alias("_before")
    if only_last:
        latest = packed.withColumn("_i", F.size("_all") - 1).withColumn("_now", F.get("_all", F.col("_i")))
        filled = latest.select("*", first, before, last.alias(period))
    else:
        following = F.get("_all", F.col("_i") + 1)["_p"]
        until = F.coalesce(F.date_sub(following, 1) if is_date else following - 1, last)
        placed = packed.select("*", F.posexplode("_all").alias("_i", "_now")).select(
            "*", first, before, until.alias("_until")
        )
        filled = placed.select("*", F.explode(F.sequence(F.col("_now._p"), F.col("_until"))).alias(period))
    return filled.withColumn("is_active", F.col(period) == F.col("_now._p"))
