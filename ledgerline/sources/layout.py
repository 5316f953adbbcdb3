"""Physical layout: sorted copies, bucketed tables, file statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.grouping import assign_part, large_groups, replicate, spread, with_parts
from ledgerline.session import scratch_path


def spread_by(
    df: DataFrame, by: Sequence[str], partitions: int | None = None, max_rows: int = 5_000_000
) -> DataFrame:
    """Bring rows of the same ``by`` values together, but not more than a task can hold.

    Without ``partitions`` adaptive execution sizes the partitions: it splits
    large values and joins small ones. With a fixed number, a value above
    ``max_rows`` is dealt out over several partitions.
    """
    columns = [F.col(c) for c in by]
    if partitions is None:
        return df.hint("rebalance", *columns)
    dealt = spread(df, by, df.columns, max_rows, "_part")
    return dealt.repartition(partitions, *columns, F.col("_part")).drop("_part")


def sorted_within(
    df: DataFrame, by: Sequence[str], sort: Sequence[str], partitions: int | None = None, max_rows: int = 5_000_000
) -> DataFrame:
    """``spread_by`` with each partition sorted on its own: no global order, no range sampling."""
    return spread_by(df, by, partitions, max_rows).sortWithinPartitions(*sort)


def sorted_global(df: DataFrame, sort: Sequence[str]) -> DataFrame:
    """A total order over all rows by range partitions."""
    return df.orderBy(*sort)


def write_by_year(df: DataFrame, path: str, day: str, sort: Sequence[str] = ()) -> str:
    """Parquet folders by the year of ``day``, rows of a day kept together and sorted if asked."""
    dated = df.withColumn("year", F.year(day))
    placed = spread_by(dated, ["year", day])
    if sort:
        placed = placed.sortWithinPartitions("year", *sort)
    placed.write.partitionBy("year").parquet(path)
    return path


def file_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files, bytes and rows of each named table, read from file metadata and counts."""
    out = None
    for name, path in paths.items():
        meta = spark.read.parquet(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
        )
        per_file = meta.groupBy("file", "size").agg(F.count(F.lit(1)).alias("rows"))
        one = per_file.agg(
            F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"), F.sum("rows").alias("n_rows")
        ).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _whole_number(df: DataFrame, column: str) -> Column:
    """A column's place in its order as a whole number: days, microseconds, or the first five bytes of a text."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind == "string":
        head = F.rpad(F.substring(value.cast("binary"), 1, 5), 5, b"\0")
        return F.conv(F.hex(head), 16, 10).cast("long")
    if kind == "date":
        return F.unix_date(value).cast("long")
    return F.unix_micros(value) if kind == "timestamp" else value.cast("long")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 5, name: str = "interleaved") -> DataFrame:
    """Add a sort key that mixes the leading bits of several columns, so that rows near in all of them lie together.

    Each column is scaled to 0 .. 2^``bits`` - 1 between its least and largest
    value; null counts as least. Bits go in turn, the first column's first.
    """
    ends = [f(_whole_number(df, c)).alias(f"{tag}{i}") for i, c in enumerate(columns) for tag, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*ends).first()
    top = (1 << bits) - 1
    key = F.lit(0).cast("long")
    for i, column in enumerate(columns):
        low, high = row[f"lo{i}"] or 0, row[f"hi{i}"] or 0
        # both factors are below 2^51, so the quotient is exact where it is rounded down
        scaled = F.coalesce(F.floor((_whole_number(df, column) - low) * top / max(high - low, 1)), F.lit(0)).cast("int")
        for bit in range(bits):
            own = F.shiftright(scaled, bit).bitwiseAND(1).cast("long")
            key = key + F.shiftleft(own, bit * len(columns) + len(columns) - 1 - i)
    return df.withColumn(name, key)


def in_equal_files(df: DataFrame, order: Sequence[str], path: str, files: int) -> str:
    """Store ``df`` in ``files`` folders of equal row counts, cut from its total ``order``.

    The order is made by range partitions; their rows are counted and the counts
    added up, so no task sees all rows. ``order`` must tell all rows apart for
    files that do not depend on arrival.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*order).select("*", F.monotonically_increasing_id().alias("_at"))
    fresh = scratch_path(spark, "ordered")
    ordered.write.parquet(fresh)
    rows = spark.read.schema(ordered.schema).parquet(fresh).withColumn("_run", F.shiftright("_at", 33))
    runs = rows.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    total = Window.partitionBy(F.lit(1))
    starts = runs.select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(total).alias("_total"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = rows.join(starts, "_run").withColumn("file", F.floor(place * files / F.col("_total")).cast("int"))
    dealt = placed.repartition("file").sortWithinPartitions("file", "_at")
    dealt.select(*df.columns, "file").write.partitionBy("file").parquet(path)
    return path


def files_touched(spark: SparkSession, path: str, filters: dict[str, tuple[str, object]]) -> DataFrame:
    """One row: files of ``in_equal_files``, their bytes and rows, and how many each filter (column, value) must open by their least and largest values."""
    columns = sorted({c for c, _ in filters.values()})
    ends = [f(c).alias(f"{tag}_{c}") for c in columns for tag, f in (("lo", F.min), ("hi", F.max))]
    rows = spark.read.parquet(path)
    place, size = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")
    per_file = rows.select(*columns, place, size).groupBy("_file", "_size").agg(F.count(F.lit(1)).alias("_n"), *ends)
    hit = {n: F.count_if(F.lit(v).between(F.col(f"lo_{c}"), F.col(f"hi_{c}"))).alias(n) for n, (c, v) in filters.items()}
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_size", "n_bytes"), ("_n", "n_rows"))]
    return per_file.agg(F.count(F.lit(1)).alias("n_files"), *sums, *hit.values())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files at ``path``, from their listing."""
    return spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0


def layout_study(
    df: DataFrame, sort_keys: dict[str, Sequence[str]], total_order: Sequence[str], filters: dict[str, tuple[str, object]], files: int
) -> DataFrame:
    """A row per candidate order: files, rows, bytes on disk, files that each filter touches, and the rank by bytes.

    Every candidate is followed by ``total_order``, which tells rows apart, and
    cut into ``files`` files of equal row counts, so that both figures can be
    repeated on the same rows and engine.
    """
    spark = df.sparkSession
    out = None
    for name, sort in sort_keys.items():
        order = list(dict.fromkeys([*sort, *total_order]))
        path = in_equal_files(df, order, scratch_path(spark, f"layout-{name}"), files)
        one = files_touched(spark, path, filters).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    by_size = Window.partitionBy(F.lit(1)).orderBy("n_bytes", "table_name")  # one row per candidate
    return out.withColumn("rank_by_bytes", F.row_number().over(by_size))


#: More buckets than this and a table's files outgrow the catalog; the engine refuses 100,000.
MOST_BUCKETS = 1 << 16


def buckets_for(rows: int, rows_per_bucket: int = 5_000_000, least: int = 16) -> int:
    """A power of two from ``least`` to ``MOST_BUCKETS``; up to that, a bucket holds at most ``rows_per_bucket``.

    Beyond, buckets grow instead; a bucket is sorted by its task, which spills.
    """
    buckets = least
    while buckets * rows_per_bucket < rows and buckets < MOST_BUCKETS:
        buckets *= 2
    return buckets


def stored_parts(df: DataFrame, key: str, max_rows: int) -> tuple[DataFrame, int]:
    """``group_parts`` of one key, kept in a small table, and the row count, in one pass."""
    spark = df.sparkSession
    seen = Observation()
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    watched = counted.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    big = large_groups(watched, [key], max_rows)
    path = scratch_path(spark, "parts")
    big.write.parquet(path)
    return spark.read.schema(big.schema).parquet(path), seen.get["rows"]


def write_bucketed(
    df: DataFrame, label: str, keys: Sequence[str], buckets: int = 16, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Store ``df`` in a bucketed, sorted table, perhaps with a folder per ``partition_by`` value, and return the table.

    The files go below the shared scratch root. Rows are shuffled into their
    buckets first, so each bucket of a folder is one file rather than one per
    task.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = (
        df.repartition(buckets, *[F.col(k) for k in keys])
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", scratch_path(spark, label))
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return spark.table(name)


def pruning_session(spark: SparkSession) -> SparkSession:
    """A session over the same catalog whose joins of stored tables prune folders and stay in place.

    Folders of one side are pruned by the rows that a filter leaves on the other,
    also where neither side is small enough to broadcast; and buckets count as
    co-located though the join compares further columns. The caller's own session
    keeps its settings.
    """
    other = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.autoBroadcastJoinThreshold"):
        other.conf.set(name, spark.conf.get(name))
    other.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return other


def table_name(df: DataFrame) -> str:
    """The catalog name of a frame that is a stored table and nothing else."""
    return df._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().unquotedString()


_STORED: dict[tuple, tuple[tuple, object]] = {}


def files_mark(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Number, bytes and latest change of the files at ``paths``: another mark, other content."""
    files = spark.read.format("binaryFile").load(list(paths))
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max(F.unix_micros("modificationTime"))).first())


def stored_once(spark: SparkSession, key: tuple, paths: Sequence[str], build: Callable[[], object]) -> object:
    """What ``build`` stored for ``key`` from the files at ``paths``, and later queries read.

    It runs once per application, and again when those files change.
    """
    full, mark = (spark.sparkContext.applicationId, *key, *paths), files_mark(spark, paths)
    if full not in _STORED or _STORED[full][0] != mark:
        _STORED[full] = mark, build()
    return _STORED[full][1]


def colocate(
    large: DataFrame,
    others: dict[str, tuple[DataFrame, Sequence[str] | None]],
    key: str,
    by: Sequence[str],
    buckets: int | None = None,
    max_rows: int = 1_000_000,
    partition_by: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Bucket several tables on ``key`` so that they join without a shuffle.

    A bucket join cannot split a bucket while it runs, so an oversized key is
    split here: rows of ``large`` are hashed by ``by`` over the key's parts.
    Another table with its own ``by`` columns is hashed the same way; one given
    with ``None`` is repeated once per part. All are bucketed on (key, part).
    With ``partition_by``, columns that all tables have, each table has a folder
    per value and buckets inside. A join that compares further columns, such as
    those, stays in place only in a ``pruning_session``.
    """
    parts, rows = stored_parts(large, key, max_rows)
    number = buckets or buckets_for(rows)
    keys = [key, "part"]

    def store(name: str, df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
        sized = with_parts(df, parts, [key])
        placed = replicate(sized) if columns is None else assign_part(sized, columns)
        return write_bucketed(placed, name, keys, number, partition_by)

    return store("large", large, by), {name: store(name, df, columns) for name, (df, columns) in others.items()}
