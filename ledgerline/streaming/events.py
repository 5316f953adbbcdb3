"""Event sources: JSON messages with an event time given as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The two message layouts and their time format.
WEB_EVENT_SCHEMA = (
    "url string, referrer string, user_agent string, host string, ip string, headers string, event_time string"
)
PROCESSED_SCHEMA = "ip string, event_time string, referrer string, host string, url string, geodata string"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def topic_options(servers: str, topic: str, start: str = "latest", **security: str) -> dict[str, str]:
    """Reader options for a broker topic; ``security`` entries are passed on as they are."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **security}


def read_messages(spark: SparkSession, fmt: str, options: dict[str, str] | None = None, path: str | None = None) -> DataFrame:
    """One text column ``value`` per message.

    ``kafka`` takes the usual broker options (start position, security) as
    they are; ``text`` reads files with one message per line.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_messages(
    messages: DataFrame,
    schema: str = WEB_EVENT_SCHEMA,
    time_format: str = EVENT_TIME_FORMAT,
    time: str = "event_timestamp",
) -> DataFrame:
    """Message fields plus the event time as a timestamp, null when it cannot be read.

    ``is_bad`` marks messages whose JSON or time is unusable; send those to a
    side output instead of losing them in a window.
    """
    fields = messages.select("value", F.from_json("value", schema).alias("_m"))
    parsed = fields.select(
        "_m.*",
        F.try_to_timestamp(F.col("_m.event_time"), F.lit(time_format)).alias(time),
        F.col("value").alias("raw"),
    )
    return parsed.withColumn("is_bad", F.col(time).isNull())


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_bad")).drop("is_bad", "raw")


def bad_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_bad").select("raw")


def to_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``, null fields kept: the form a topic sink wants."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def read_table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream, with the table's own schema.

    The last part of the path is given as a pattern: a plain path must be a folder.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parent, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{parent}/{{{name}}}")
