"""The library's inputs derived from the given tables, as DataFrames.

Each view has a twin of the same name in ``sqlviews``. Nothing here filters the
tables: nulls, repeated rows and gaps are added by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.grouping import dealt
from ledgerline.session import scratch_path
from ledgerline.sources.files import write_partitioned


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, label: str, by: str) -> DataFrame:
    """Write snapshots once to a table with a folder per value of ``by`` and read it."""
    path = write_partitioned(df, scratch_path(spark, label), [by])
    return spark.read.schema(df.schema).parquet(path)


def last_year(spark: SparkSession, sf_dir: str, name: str, time: str) -> int:
    """The latest year in a table, 0 for an empty one."""
    return table(spark, sf_dir, name).agg(F.max(F.year(time))).first()[0] or 0


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def repeated(times: Column) -> Column:
    """Explode to repeat a row; the position column is dropped by the caller."""
    return F.explode(F.sequence(F.lit(1), times))


def web_events_of(events: DataFrame) -> DataFrame:
    """Events as web hits; also works on a stream of the events table."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    referrers = F.array(
        F.lit("https://www.linkedin.com/feed"),
        F.lit("https://t.co/abc"),
        F.lit("https://www.google.com/search"),
        F.lit("https://lnkd.in/xyz"),
        F.lit("https://news.example.org/today"),
        F.lit(None).cast("string"),
        F.lit("https://blog.example.net"),
    )
    copies = F.when(F.col("event_id") % 20 == 0, 2).otherwise(1)
    ip = F.concat_ws(
        ".", F.lit("10"), F.floor(user / 256) % 256, user % 256, k % 4
    )
    return events.withColumn("_copy", repeated(copies)).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_id") % 50 != 0, user).alias("user_id"),
        k.cast("long").alias("device_id"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        F.concat(F.lit("h"), (k % 3).cast("string")).alias("host"),
        ip.alias("ip"),
        F.get(referrers, (F.col("event_id") % 7).cast("int")).alias("referrer"),
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_events_of(table(spark, sf_dir, "events"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buying counts as being active."""
    return web_events(spark, sf_dir).filter(F.col("url") == "/purchase")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("device_id"),
        F.col("p_brand").alias("browser_type"),
        F.col("p_type").alias("device_type"),
        F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("os"), (F.col("p_size") % 5).cast("string"))).alias("os_type"),
    )


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players, order years as seasons; unique on (player_name, season)."""
    seasons = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("season"))
        .agg(
            F.count(F.lit(1)).alias("gp"),
            F.sum(cents("o_totalprice")).alias("_cents"),
            F.count_if(F.col("o_orderstatus") == "F").alias("reb"),
            F.count_if(F.col("o_orderstatus") == "P").alias("ast"),
            F.count_if(F.col("o_orderstatus") == "O").alias("weight"),
        )
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = seasons.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("c_name").alias("player_name"),
        (F.lit(180) + F.col("c_custkey") % 30).cast("string").alias("height"),
        F.col("c_mktsegment").alias("college"),
        F.col("n_name").alias("country"),
        (F.lit(1990) + F.col("c_custkey") % 6).cast("string").alias("draft_year"),
        (F.col("c_custkey") % 2 + 1).cast("string").alias("draft_round"),
        (F.col("c_custkey") % 60 + 1).cast("string").alias("draft_number"),
        "gp",
        (F.floor(F.col("_cents") / 20000) / 100.0).alias("pts"),
        "reb",
        "ast",
        "weight",
        "season",
    )


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as actors, order lines as films."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("actorid"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_suppkey")).alias("film"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").cast("int").alias("votes"),
        F.round(F.col("l_discount") * 100).cast("int").alias("rating"),
        F.concat_ws(
            "-", F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
        ).alias("filmid"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as repeated records of their nation's team."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.col("s_nationkey").cast("long").alias("team_id"),
        F.concat(F.lit("T"), F.col("s_nationkey").cast("string")).alias("abbreviation"),
        F.col("s_name").alias("nickname"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("arena"),
        (F.lit(1900) + F.col("s_nationkey")).alias("yearfounded"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games between 25 teams."""
    home = F.col("o_custkey") % 25
    visitor = (home + 1 + F.col("o_orderkey") % 24) % 25
    wins = F.floor("o_totalprice") % 2
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        home.alias("home_team_id"),
        visitor.alias("visitor_team_id"),
        wins.cast("int").alias("home_team_wins"),
        (F.lit(90) + wins * 10 + F.col("o_orderkey") % 7).cast("int").alias("pts_home"),
        (F.lit(97) + F.col("o_orderkey") % 3).cast("int").alias("pts_away"),
    )


def game_details(spark: SparkSession, sf_dir: str, by_game: bool = False) -> DataFrame:
    """Order lines as player appearances, some of them twice.

    ``by_game`` deals both sides out by the game over tasks of bounded size, for
    queries that go on by game; others leave the join to adaptive execution.
    """
    lines = table(spark, sf_dir, "lineitem")
    g = games(spark, sf_dir).select("game_id", "home_team_id", "visitor_team_id")
    if by_game:
        rows = lines.count()
        lines, g = dealt(lines, ["l_orderkey"], rows), dealt(g, ["game_id"], rows)
    joined = lines.join(g, F.col("l_orderkey") == F.col("game_id"))
    qty, line, supp = F.col("l_quantity").cast("int"), F.col("l_linenumber"), F.col("l_suppkey")
    disc, tax = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int")
    team = F.when(line % 2 == 0, F.col("visitor_team_id")).otherwise(F.col("home_team_id"))
    comment = (
        F.when(supp % 10 == 1, "DNP - Coach")
        .when(supp % 10 == 2, "DND - Injury")
        .when(supp % 10 == 3, "NWT - Personal")
    )
    clock = (
        F.when(supp % 7 == 0, F.lit(None).cast("string"))
        .when(supp % 7 == 1, qty.cast("string"))
        .otherwise(F.concat(qty.cast("string"), F.lit(":"), F.lpad((line * 7).cast("string"), 2, "0")))
    )
    copies = F.when(supp % 5 == 0, 2).otherwise(1)
    return joined.withColumn("_copy", repeated(copies)).select(
        "game_id",
        team.alias("team_id"),
        F.concat(F.lit("T"), team.cast("string")).alias("team_abbreviation"),
        F.col("l_partkey").alias("player_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("player_name"),
        F.col("l_returnflag").alias("start_position"),
        comment.alias("comment"),
        clock.alias("min"),
        F.floor(qty / 3).cast("int").alias("fgm"),
        F.floor(qty / 2).cast("int").alias("fga"),
        (line % 4).alias("fg3m"),
        (line % 4 + 2).alias("fg3a"),
        tax.alias("ftm"),
        (tax + 1).alias("fta"),
        (line % 3).alias("oreb"),
        disc.alias("dreb"),
        (line % 3 + disc).alias("reb"),
        line.alias("ast"),
        (supp % 4).cast("int").alias("stl"),
        (supp % 3).cast("int").alias("blk"),
        (supp % 6).cast("int").alias("turnovers"),
        (line % 6).alias("pf"),
        qty.alias("pts"),
        (qty - 25).alias("plus_minus"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        (F.col("o_orderstatus") == "F").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        (F.col("o_custkey") % 25).cast("int").alias("mapid"),
        F.to_date("o_orderdate").alias("completion_date"),
    )


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("player_gamertag"),
        F.col("l_quantity").cast("int").alias("player_total_kills"),
        F.col("l_linenumber").alias("player_total_deaths"),
    )


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part type; the type is the medal's id."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("medal_id"), F.concat(F.lit("Medal "), F.lower("p_type")).alias("name")
    ).distinct()


def medals_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("player_gamertag"),
        F.col("p_type").alias("medal_id"),
        F.col("l_linenumber").alias("count"),
    )


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")


def purchases_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as timed outcomes; the first one of a user is the exposure."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
        cents("o_totalprice").alias("amount_cents"),
    )


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight neighbouring /24 blocks per nation; nation 13 is missing on purpose."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    base = 10 * 256 * 256 * 256
    start = F.lit(base).cast("long") + F.col("n_nationkey") * (8 * 256)
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("n_nationkey") != 13)
        .select(
            start.alias("ip_from"),
            (start + (8 * 256 - 1)).alias("ip_to"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("state"),
            F.concat(F.lit("city"), F.col("n_nationkey").cast("string")).alias("city"),
        )
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("order_day")
    )
