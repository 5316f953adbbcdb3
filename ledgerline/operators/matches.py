"""Match statistics over co-located match, detail and medal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ratio


def kills_per_game(details: DataFrame) -> DataFrame:
    """Average kills per match of each player."""
    per_match = details.groupBy("player_gamertag", "match_id").agg(F.sum("player_total_kills").alias("_kills"))
    return (
        per_match.groupBy("player_gamertag")
        .agg(F.sum("_kills").alias("total_kills"), F.count(F.lit(1)).alias("n_matches"))
        .withColumn("kills_per_game", ratio(F.col("total_kills"), F.col("n_matches")))
    )


def matches_by(matches: DataFrame, details: DataFrame, column: str) -> DataFrame:
    """Matches with details per value; details shrink to their matches before the join."""
    played = matches.join(details.select("match_id").distinct(), "match_id", "left_semi")
    return played.groupBy(column).agg(F.count_distinct("match_id").alias("n_matches"))


def name_maps(df: DataFrame, maps: DataFrame) -> DataFrame:
    """Replace the map id by the map's name."""
    return df.join(maps.select("mapid", F.col("name").alias("map_name")), "mapid").drop("mapid")


def medals_by_map(medal_counts: DataFrame, matches: DataFrame, medals: DataFrame, maps: DataFrame) -> DataFrame:
    """Medals won per map and medal.

    Medals are added up per match before they meet the matches; whether the two
    small dimensions are broadcast is decided by their size while the query runs.
    """
    per_match = medal_counts.groupBy("match_id", "medal_id").agg(F.sum("count").alias("_n"))
    per_map = (
        per_match.join(matches.select("match_id", "mapid"), "match_id")
        .groupBy("mapid", "medal_id")
        .agg(F.sum("_n").alias("n_medals"))
    )
    named = per_map.join(medals.select("medal_id", F.col("name").alias("medal")), "medal_id")
    return name_maps(named, maps).select("map_name", "medal", "n_medals")


def match_cube(details: DataFrame, matches: DataFrame, medal_counts: DataFrame, medals: DataFrame, maps: DataFrame) -> DataFrame:
    """Medals, medal winners' kills and matches per playlist, map and medal.

    ``details`` is unique on (match_id, part, player), ``medal_counts`` on
    those and the medal: both come bucketed like ``matches``. The joins use the
    bucket keys alone and compare the player afterwards (as a range of one, or
    it would become a join key and ask for another shuffle).
    """
    place = ["match_id", "part"]
    won = medal_counts.withColumnRenamed("player_gamertag", "_winner")
    joined = details.join(matches, place).join(won, place)
    joined = joined.filter(F.col("player_gamertag").between(F.col("_winner"), F.col("_winner")))
    per_match = joined.groupBy("playlist_id", "mapid", "medal_id", "match_id").agg(
        F.sum("n_medals").alias("_medals"), F.sum("kills").alias("_kills")
    )
    cube = per_match.groupBy("playlist_id", "mapid", "medal_id").agg(
        F.sum("_medals").alias("n_medals"), F.sum("_kills").alias("kills"), F.count(F.lit(1)).alias("n_matches")
    )
    named = cube.join(medals.select("medal_id", F.col("name").alias("medal")), "medal_id")
    return name_maps(named, maps).drop("medal_id")


def top(df: DataFrame, value: str, tie: str, k: int = 1) -> DataFrame:
    """The k largest rows; ties go to the smaller ``tie`` value."""
    return df.orderBy(F.col(value).desc(), F.col(tie)).limit(k)
