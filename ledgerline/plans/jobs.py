"""Batch job: read a source, apply a pure transformation, replace the target."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from ledgerline.sources.files import write_partitioned


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` while several results are stored from it, and release it.

    What is kept is a copy: if an executor is lost its part is computed again.
    Write results inside the block; one that runs later computes ``df`` anew.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def run_job(
    spark: SparkSession,
    source: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Source and target are parquet paths and must differ.

    With ``partition_by`` only the partitions present in the result are
    replaced, so a daily rerun leaves other days alone.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("a job cannot overwrite the path it reads")
    result = transform(spark.read.parquet(source))
    if partition_by:
        write_partitioned(result, target, partition_by)
    else:
        result.write.mode("overwrite").parquet(target)


def run_table_job(
    spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame], target: str
) -> None:
    """The same between catalog tables; columns are inserted by name."""
    if source == target:
        raise ValueError("a job cannot overwrite the table it reads")
    result = transform(spark.table(source))
    if not spark.catalog.tableExists(target):
        result.write.saveAsTable(target)
        return
    result.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
