"""Ordered calculations over keys of any size.

A window partitioned by key alone sends the whole key to one task. Here the
key's rows are cut into time chunks first: each chunk is summarised with a
partial aggregate, the short list of summaries is put in order per key, and
the result is joined back on (key, chunk). ``chunk`` must not decrease in the
row order; ``chunked`` makes one that holds a limited number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(keys: Sequence[str], chunk: str) -> Window:
    return (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )


def chunked(
    df: DataFrame, keys: Sequence[str], coarse: str, fine: str, rows: int = 100_000, name: str = "_chunk"
) -> DataFrame:
    """Add ``name``, a chunk that follows (``coarse``, ``fine``) and the number of rows, however sparse the values.

    Rows are counted per key and coarse value, e.g. a day. Consecutive days share
    a chunk of some ``rows``; a day with more is cut into stretches of the whole
    number ``fine`` between its least and largest there.
    """
    counted = df.groupBy(*keys, coarse).agg(
        F.count(F.lit(1)).alias("_n"), F.min(fine).alias("_low"), F.max(fine).alias("_high")
    )
    before = F.coalesce(F.sum("_n").over(_before(keys, coarse)), F.lit(0))
    placed = counted.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(coarse).alias("_coarse"),
        F.floor(before / rows).alias("_chunk_of"), F.ceil(F.col("_n") / rows).alias("_parts"), "_low", "_high",
    )
    same = F.col(coarse).eqNullSafe(F.col("_coarse"))
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    share = (F.col(fine) - F.col("_low")) / (F.col("_high") - F.col("_low") + 1)
    part = F.when(F.col("_parts") > 1, F.coalesce(F.floor(share * F.col("_parts")), F.lit(-1))).otherwise(0)
    return df.join(placed, same).select(*df.columns, F.struct(F.col("_chunk_of").alias("chunk"), part.alias("part")).alias(name))


def running_sums(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    """Add running totals (current row included) of ``values`` per key in ``order``."""
    work = df.select("*", *[v.cast("long").alias(f"_v_{n}") for n, v in values.items()])
    totals = work.groupBy(*keys, chunk).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    earlier = totals.select(
        *keys,
        chunk,
        *[
            F.coalesce(F.sum(f"_t_{n}").over(_before(keys, chunk)), F.lit(0)).alias(f"_o_{n}")
            for n in values
        ],
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = work.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_l_{n}") for n in values])
    joined = local.join(earlier, [*keys, chunk])
    return joined.select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in values]
    )


def previous_row(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], columns: Sequence[str], name: str
) -> DataFrame:
    """Add ``name``: a struct of ``columns`` of the row before, or null for the first row."""
    inside = Window.partitionBy(*keys, chunk).orderBy(*order)
    picked = F.struct(*columns)
    ends = df.groupBy(*keys, chunk).agg(F.max_by(picked, F.struct(*order)).alias("_end"))
    earlier = ends.select(
        *keys, chunk, F.lag("_end").over(Window.partitionBy(*keys).orderBy(chunk)).alias("_carry")
    )
    local = df.withColumn("_here", F.lag(picked).over(inside))
    return (
        local.join(earlier, [*keys, chunk])
        .withColumn(name, F.coalesce("_here", "_carry"))
        .select(*df.columns, name)
    )


def stretch_best(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    value: Column,
    length: int,
    name: str,
) -> DataFrame:
    """Largest total of ``value`` over ``length`` consecutive rows of each key.

    Rows are numbered per key, cut into blocks of that numbering, and every
    block also receives the ``length - 1`` rows before it, so a bounded frame
    never leaves its block. Keys with fewer rows give no result.
    """
    block_rows = max(8 * length, 4096)
    numbered = running_sums(df, keys, chunk, order, {"_pos": F.lit(1)}).select(
        *keys, "_pos", value.cast("long").alias("_value")
    )
    home = F.floor((F.col("_pos") - 1) / block_rows)
    reach = F.floor((F.col("_pos") + (length - 2)) / block_rows)
    placed = numbered.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(home, reach)))
    frame = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-(length - 1), 0)
    summed = placed.withColumn("_sum", F.sum("_value").over(frame))
    full = summed.filter((F.col("_home") == F.col("_block")) & (F.col("_pos") >= length))
    return full.groupBy(*keys).agg(F.max("_sum").alias(name))


def longest_run(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], hit: Column, name: str
) -> DataFrame:
    """Longest unbroken run of ``hit`` rows per key, 0 when there is none."""
    flagged = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    runs = running_sums(flagged, keys, chunk, order, {"_run": F.when(F.col("_hit"), 0).otherwise(1)})
    sized = runs.groupBy(*keys, "_run").agg(F.count_if("_hit").alias("_len"))
    return sized.groupBy(*keys).agg(F.max("_len").alias(name))
