"""Game facts and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import DETAIL_COLUMNS, first_row, using
from ledgerline.operators import facts, quality
from ledgerline.operators.grouping import dedupe

KEY = ["game_id", "team_id", "player_id"]
INTEGERS = [f"m_{m}" for m in facts.MEASURES]


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.build_facts(views.game_details(spark, sf_dir), views.games(spark, sf_dir))


@query(
    "f1_duplicate_keys",
    using(
        "SELECT game_id, team_id, player_id, count(*) AS n_rows FROM game_details GROUP BY 1, 2, 3 HAVING count(*) > 1",
        "game_details",
    ),
)
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(views.game_details(spark, sf_dir, by_game=True), KEY)


WHOLE = {"fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "turnovers", "pf",
         "pts", "plus_minus"}


@query(
    "f2_dedupe",
    using(
        "SELECT " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in WHOLE else c for c in DETAIL_COLUMNS)
        + f" FROM ({first_row('game_details', KEY, DETAIL_COLUMNS)})",
        "game_details",
    ),
)
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(views.game_details(spark, sf_dir), KEY)


FACT_SQL = """dim_game_id, CAST(dim_game_date AS VARCHAR) AS dim_game_date, dim_season, dim_team_id, dim_player_id,
        dim_player_name, dim_start_position, dim_is_playing_at_home, dim_did_not_play, dim_did_not_dress,
        dim_not_with_team, round(m_minutes, 6) AS m_minutes, """ + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in INTEGERS)


@query("f3_fact_build", using(f"SELECT {FACT_SQL} FROM facts", "facts"))
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_table(spark, sf_dir)


TEAM_COLUMNS = ("team_id", "abbreviation", "nickname", "city", "arena", "yearfounded")


@query(
    "f4_attach_dim",
    using(
        f"""SELECT dim_game_id, dim_team_id, dim_player_id, CAST(m_pts AS BIGINT) AS m_pts, abbreviation, nickname, city, arena
        FROM facts JOIN ({first_row("teams", ["team_id"], TEAM_COLUMNS)}) t ON t.team_id = dim_team_id""",
        "facts",
        "teams",
    ),
)
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = dedupe(views.teams(spark, sf_dir), ["team_id"])
    joined = facts.attach_dimension(fact_table(spark, sf_dir), teams, "dim_team_id", "team_id")
    return joined.select(
        "dim_game_id", "dim_team_id", "dim_player_id", "m_pts", "abbreviation", "nickname", "city", "arena"
    )


@query(
    "f5_bail_rate",
    using(
        """SELECT dim_player_name, count(*) AS num_games, count(*) FILTER (dim_not_with_team) AS bailed_num,
        round(CAST(count(*) FILTER (dim_not_with_team) AS DOUBLE) / count(*), 6) AS bail_pct FROM facts GROUP BY 1""",
        "facts",
    ),
)
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact_table(spark, sf_dir)
    return facts.flag_rate(rows, "dim_player_name", F.col("dim_not_with_team"), "num_games", "bailed_num", "bail_pct")


# Lower bounds (exclusive) of the hit buckets.
HIT_BUCKETS = ((80, "heavy"), (65, "regular"), (50, "light"))


@query(
    "f18_bucketize",
    using(
        """SELECT CASE WHEN n > 80 THEN 'heavy' WHEN n > 65 THEN 'regular' WHEN n > 50 THEN 'light' ELSE 'rare' END AS hit_bucket,
        count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_hits
        FROM (SELECT user_id, count(*) AS n FROM web_events WHERE user_id IS NOT NULL GROUP BY 1) GROUP BY 1""",
        "web_events",
    ),
)
def f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = views.web_events(spark, sf_dir).filter("user_id IS NOT NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    labelled = facts.bucketize(hits, "n", HIT_BUCKETS, "rare", "hit_bucket")
    return labelled.groupBy("hit_bucket").agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_hits"))


@query(
    "f18_sample_metric",
    using(
        """SELECT host, count(*) AS n_hits, count(DISTINCT user_id) AS n_users FROM web_events
        WHERE CAST(('0x' || substr(md5('sample:' || user_id), 1, 8)) AS BIGINT) % 100 < 20 GROUP BY 1""",
        "web_events",
    ),
)
def f18b(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = facts.sample_by_key(views.web_events(spark, sf_dir), "user_id", 20)
    return sampled.groupBy("host").agg(F.count(F.lit(1)).alias("n_hits"), F.count_distinct("user_id").alias("n_users"))


@query(
    "q1_unique_key",
    using(
        """SELECT * FROM (
        SELECT 'game_details' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
               count(*) FILTER (n > 1) AS n_repeated_keys, CAST(0 AS BIGINT) AS n_null_key_rows
        FROM (SELECT count(*) AS n FROM game_details GROUP BY game_id, team_id, player_id)
        UNION ALL
        SELECT 'player_seasons', CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (n > 1), CAST(0 AS BIGINT)
        FROM (SELECT count(*) AS n FROM player_seasons GROUP BY player_name, season)
        UNION ALL
        SELECT 'web_events', CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (n > 1),
               CAST(coalesce(sum(n) FILTER (user_id IS NULL), 0) AS BIGINT)
        FROM (SELECT user_id, count(*) AS n FROM web_events GROUP BY user_id, event_time))""",
        "game_details",
        "player_seasons",
        "web_events",
    ),
)
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = [
        ("game_details", views.game_details(spark, sf_dir, by_game=True), KEY),
        ("player_seasons", views.player_seasons(spark, sf_dir), ["player_name", "season"]),
        ("web_events", views.web_events(spark, sf_dir), ["user_id", "event_time"]),
    ]
    out = None
    for name, df, keys in checked:
        one = quality.key_report(df, keys).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "q2_enum_check",
    using(
        """SELECT coalesce(os_type, '(null)') AS bad_value, count(*) AS n_rows FROM devices
        WHERE os_type IS NULL OR os_type NOT IN ('os0', 'os1', 'os2') GROUP BY 1""",
        "devices",
    ),
)
def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outside_values(views.devices(spark, sf_dir), "os_type", ["os0", "os1", "os2"])


@query(
    "q3_null_contract",
    using(
        """SELECT 'user_id' AS column_name, count(*) FILTER (user_id IS NULL) AS n_nulls, true AS is_ok FROM web_events
        UNION ALL SELECT 'referrer', count(*) FILTER (referrer IS NULL), count(*) FILTER (referrer IS NULL) = 0 FROM web_events
        UNION ALL SELECT 'host', count(*) FILTER (host IS NULL), count(*) FILTER (host IS NULL) = 0 FROM web_events
        UNION ALL SELECT 'event_time', count(*) FILTER (event_time IS NULL), count(*) FILTER (event_time IS NULL) = 0 FROM web_events""",
        "web_events",
    ),
)
def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(views.web_events(spark, sf_dir), ["referrer", "host", "event_time"], ["user_id"])
