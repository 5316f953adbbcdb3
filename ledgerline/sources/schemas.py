"""Stored tables: columns, key, partition column, and how to create them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.quality import duplicate_keys
from ledgerline.session import scratch_path


@dataclass(frozen=True)
class Table:
    """Columns as DDL text, the key Spark itself does not enforce, the partition columns."""

    name: str
    columns: str
    key: tuple[str, ...]
    partitioned_by: tuple[str, ...] = ()


# The stored tables of the model.
TABLES = {
    t.name: t
    for t in (
        Table(
            "players",
            "player_name string, height string, college string, country string, draft_year string, draft_round string, "
            "draft_number string, history array<struct<season int, gp bigint, pts double, reb bigint, ast bigint, weight bigint>>, "
            "class string, years_since_last_active int, is_active boolean, current int",
            ("player_name", "current"),
            ("current",),
        ),
        Table(
            "players_scd",
            "player_name string, class string, is_active boolean, start_period int, end_period int, current int",
            ("player_name", "start_period", "current"),
            ("current",),
        ),
        Table(
            "actors",
            "actorid bigint, n_items bigint, items array<struct<year int, film string, votes int, rating int, filmid string>>, "
            "quality_class string, is_active boolean, current int",
            ("actorid", "current"),
            ("current",),
        ),
        Table(
            "actors_films",
            "actorid bigint, stretch bigint, items array<struct<year int, film string, votes int, rating int, filmid string>>, "
            "closed_in int",
            ("actorid", "stretch"),
            ("closed_in",),
        ),
        Table(
            "actors_history_scd",
            "actorid bigint, quality_class string, is_active boolean, start_period int, end_period int, current int",
            ("actorid", "start_period", "current"),
            ("current",),
        ),
        Table("vertices", "identifier bigint, type string, properties map<string, string>", ("identifier", "type"), ("type",)),
        Table(
            "edges",
            "subject_identifier bigint, subject_type string, object_identifier bigint, object_type string, edge_type string, "
            "properties map<string, string>",
            ("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"),
            ("edge_type",),
        ),
        Table("users_cumulated", "user_id bigint, dates_active array<date>, date date", ("user_id", "date"), ("date",)),
        Table("user_datelist_int", "user_id bigint, datelist_int bigint, date date", ("user_id", "date"), ("date",)),
        Table(
            "user_devices_cumulated",
            "user_id bigint, date date, device_activity_datelist map<string, array<date>>",
            ("user_id", "date"),
            ("date",),
        ),
        Table("hosts_cumulated", "host string, dates_active array<date>, date date", ("host", "date"), ("date",)),
        Table(
            "host_activity_reduced",
            "host string, month_start date, hit_array array<bigint>, unique_visitors array<bigint>",
            ("host", "month_start"),
            ("month_start",),
        ),
        Table(
            "array_metrics",
            "user_id bigint, month_start date, metric_name string, metric_array array<bigint>",
            ("user_id", "month_start", "metric_name"),
            ("month_start", "metric_name"),
        ),
        Table(
            "monthly_user_site_hits",
            "user_id bigint, hit_array array<bigint>, month_start date, first_found_date date, date_partition date",
            ("user_id", "date_partition", "month_start"),
            ("date_partition",),
        ),
        Table(
            "users_growth_accounting",
            "user_id bigint, first_active_date date, last_active_date date, daily_active_state string, "
            "weekly_active_state string, dates_active array<date>, date date",
            ("user_id", "date"),
            ("date",),
        ),
        Table(
            "processed_events",
            "ip string, event_timestamp timestamp, referrer string, host string, url string, geodata string",
            (),
        ),
        Table("processed_events_aggregated", "window_start timestamp, host string, num_hits bigint", ("window_start", "host")),
        Table(
            "processed_events_aggregated_source",
            "window_start timestamp, host string, referrer string, num_hits bigint",
            ("window_start", "host", "referrer"),
        ),
    )
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    """The table before its first snapshot: what the first step of a fold starts from."""
    return spark.createDataFrame([], TABLES[name].columns)


def create(spark: SparkSession, name: str, as_name: str | None = None, location: str | None = None) -> str:
    """Create the table unless it exists; files go below the shared scratch root by default."""
    table = TABLES[name]
    target = as_name or name
    parts = f" PARTITIONED BY ({', '.join(table.partitioned_by)})" if table.partitioned_by else ""
    place = location or scratch_path(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({table.columns}) USING parquet{parts} LOCATION '{place}'")
    return target


def drop(spark: SparkSession, name: str) -> None:
    """Forget the table if it is there; the files of a located table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


#: Partitions that one writing task keeps open; each has a buffer of its own.
OPEN_FILES = 4


def replace_partitions(df: DataFrame, target: str) -> None:
    """Insert by column name, replacing only the partitions present in ``df``.

    A task keeps up to ``OPEN_FILES`` partitions open at a time; it sorts its
    rows by partition only where it meets more.
    """
    spark = df.sparkSession
    settings = {
        "spark.sql.sources.partitionOverwriteMode": "dynamic",  # the writer's own option does not allow reading the target
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shape_problems(df: DataFrame, name: str) -> list[str]:
    """Columns that are missing, unknown or of another type than the table's."""
    wanted = dict(empty(df.sparkSession, name).dtypes)
    got = dict(df.dtypes)
    problems = [f"missing {c}" for c in wanted if c not in got]
    problems += [f"unknown {c}" for c in got if c not in wanted]
    problems += [f"{c} is {got[c]}, not {t}" for c, t in wanted.items() if c in got and got[c] != t]
    return problems


def key_problems(df: DataFrame, name: str) -> DataFrame:
    """Repeated or null keys of the table, with their row counts."""
    key = TABLES[name].key
    has_null = F.lit(False)
    for column in key:
        has_null = has_null | F.col(column).isNull()
    nulls = df.filter(has_null).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return duplicate_keys(df.filter(~has_null), key).unionByName(nulls)
