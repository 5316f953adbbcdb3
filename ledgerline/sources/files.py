"""Reading delimited and JSON files, and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch_path
from ledgerline.sources.layout import spread_by


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header. A schema avoids the extra pass that ``infer`` makes; neither gives text."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(infer).lower()).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store that the address names has the file or folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


#: Types that text may stand for, the narrowest first, and the pattern of their text.
LATTICE = (
    ("boolean", "(?i)true|false"),
    ("bigint", "[+-]?[0-9]{1,19}"),
    ("double", "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"),
    ("date", "[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("timestamp", "[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,9})?(Z|[+-][0-9]{2}:?[0-9]{2})?"),
)
#: What else a type's text may be written as.
NARROWER = {"double": ("bigint",), "timestamp": ("date",)}


def _fits(column: str, kind: str) -> Column:
    """Whether a text reads as ``kind``: by its form and as a value."""
    patterns = dict(LATTICE)
    forms = "|".join(f"({patterns[k]})" for k in (kind, *NARROWER.get(kind, ())))
    text = F.col(f"`{column}`")
    return text.rlike(f"^({forms})$") & text.try_cast(kind).isNotNull()


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type that every text of a column reads as, in one pass over all rows.

    Whole numbers and decimals meet in double, days and times in timestamp, all
    else in string. Nulls and blanks fit any type; a column of them is text.
    """
    names = texts.columns
    counts = []
    for i, name in enumerate(names):
        told = F.trim(F.col(f"`{name}`")) != ""
        counts.append(F.count_if(told).alias(f"n{i}"))
        counts += [F.count_if(told & _fits(name, kind)).alias(f"{kind}{i}") for kind, _ in LATTICE]
    row = texts.agg(*counts).first()
    fits = lambda i: (kind for kind, _ in LATTICE if row[f"n{i}"] and row[f"{kind}{i}"] == row[f"n{i}"])
    return {name: next(fits(i), "string") for i, name in enumerate(names)}


def cast_types(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as ``types``; a blank is null unless the column is text."""
    return texts.select(
        *[F.col(f"`{c}`") if t == "string" else F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).cast(t).alias(c) for c, t in types.items()]
    )


def read_csv_aside(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows that read as ``schema``, and the lines that do not, as ``line``.

    Lines are parsed once; what came of them is stored and then told apart.
    """
    kind = T.StructType.fromDDL(f"{schema}, _line string")
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    rows = stored(reader.option("enforceSchema", "true").schema(kind).csv(path), "parsed")
    bad = F.col("_line").isNotNull()
    return rows.filter(~bad).drop("_line"), rows.filter(bad).select(F.col("_line").alias("line"))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("error").option("header", "true").csv(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared scratch root and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> str:
    """Parquet folders by ``by``; with overwrite only the partitions in ``df`` are replaced.

    Rows of a folder are brought together first, so a folder gets a few sized
    files instead of one from every task.
    """
    writer = spread_by(df, by).write.mode(mode).partitionBy(*by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, and all of ``new``.

    Write the result to a new snapshot partition or path, never over the one
    being read.
    """
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)
