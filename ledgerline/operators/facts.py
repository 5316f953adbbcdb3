"""Game fact table: dimensions named ``dim_*``, measures named ``m_*``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import clock_minutes, hash_percent, ladder, mentions, ratio
from ledgerline.operators.grouping import dedupe

# The measures carried over as they are, and comment codes.
MEASURES = (
    "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
    "ast", "stl", "blk", "turnovers", "pf", "pts", "plus_minus",
)
COMMENT_FLAGS = (("DNP", "did_not_play"), ("DND", "did_not_dress"), ("NWT", "not_with_team"))
FACT_KEY = ("game_id", "team_id", "player_id")


def build_facts(details: DataFrame, games: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Typed fact rows, one per game, team and player.

    Copies are removed before the join with the games, so they are shuffled once.
    """
    one = dedupe(details, FACT_KEY, order)
    g = games.select("game_id", "game_date", "season", "home_team_id")
    flags = [mentions(F.col("comment"), code).alias(f"dim_{name}") for code, name in COMMENT_FLAGS]
    return one.join(g, "game_id").select(
        F.col("game_id").alias("dim_game_id"),
        F.col("game_date").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        *flags,
        clock_minutes(F.col("min")).alias("m_minutes"),
        *[F.col(m).cast("int").alias(f"m_{m}") for m in MEASURES],
    )


def attach_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Bring a dimension's columns back; broadcast only when it was measured to be small."""
    return facts.join(dim, facts[fact_key] == dim[dim_key])


def flag_rate(df: DataFrame, by: str, flag: Column, n: str, hits: str, rate: str) -> DataFrame:
    """Rows, flagged rows and their share per group, highest share first."""
    return (
        df.groupBy(by)
        .agg(F.count(F.lit(1)).alias(n), F.count_if(flag).alias(hits))
        .withColumn(rate, ratio(F.col(hits), F.col(n)))
        .orderBy(F.col(rate).desc_nulls_first(), by)
    )


def bucketize(
    df: DataFrame, value: str, steps: Sequence[tuple[float, str]], otherwise: str, name: str
) -> DataFrame:
    """Turn an aggregated number into a label of few values."""
    return df.withColumn(name, ladder(F.col(value), steps, otherwise))


def sample_by_key(df: DataFrame, key: str, percent: int, salt: str = "sample") -> DataFrame:
    """All rows of a stable share of keys; the same keys on every run."""
    return df.filter(hash_percent(salt, F.col(key)) < percent)
