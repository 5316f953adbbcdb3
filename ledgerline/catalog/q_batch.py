"""Batch jobs, enrichment and physical layout."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.operators import graph, matches, web
from ledgerline.operators.grouping import lists_by_range
from ledgerline.plans.jobs import cached, run_job
from ledgerline.session import scratch_path
from ledgerline.sources import files, layout

ORDER_CSV = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp,
    o_orderpriority string"""
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


@query(
    "s1_csv_read",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents,
    {STAMP.format("o_orderdate")} AS o_orderdate, o_orderpriority FROM orders""",
)
def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to CSV with a header and back through a schema."""
    rows = views.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    path = files.write_csv(rows, scratch_path(spark, "csv"))
    back = files.read_csv(spark, path, ORDER_CSV)
    return back.select(
        "o_orderkey", "o_custkey", "o_orderstatus", views.cents("o_totalprice").alias("price_cents"), "o_orderdate",
        "o_orderpriority",
    )


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a CSV file gives them without a schema: every column as text."""
    rows = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"),
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 2 == 0).alias("is_even"), "o_orderpriority",
    )
    return files.read_csv(spark, files.write_csv(rows, scratch_path(spark, "texts")))


@query(
    "s1_csv_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day,
    CASE WHEN o_orderkey % 3 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END END AS is_even, o_orderpriority FROM orders""",
)
def s1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header and no schema: all columns are text, a missing value is null."""
    return order_texts(spark, sf_dir).select("o_orderkey", "o_orderstatus", "day", "is_even", "o_orderpriority")


@query(
    "s1_csv_inferred",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents,
    strftime(o_orderdate, '%Y-%m-%d') AS day, {STAMP.format("o_orderdate")} AS o_orderdate,
    CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 2 = 0 END AS is_even, o_orderpriority,
    'bigint bigint string double date timestamp boolean string' AS types FROM orders""",
)
def s1_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text with the narrowest type that all values of a column read as, found in one pass."""
    texts = order_texts(spark, sf_dir)
    types = files.infer_types(texts)
    rows = files.cast_types(texts, types).withColumn("price_cents", views.cents("o_totalprice"))
    return rows.drop("o_totalprice").withColumn("types", F.lit(" ".join(types.values())))


@query(
    "s1_csv_bad_lines",
    """SELECT o_orderstatus AS part, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
    WHERE o_orderkey % 11 > 0 GROUP BY 1
    UNION ALL SELECT 'bad', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 11 = 0""",
)
def s1_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a schema cannot read are kept aside whole and counted, not dropped."""
    price = F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"))
    path = files.write_csv(rows, scratch_path(spark, "lines"))
    good, bad = files.read_csv_aside(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")
    totals = [F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys")]
    per_status = good.filter(F.col("o_totalprice").isNotNull()).groupBy(F.col("o_orderstatus").alias("part")).agg(*totals)
    key = F.split_part("line", F.lit(","), F.lit(1)).cast("bigint").alias("o_orderkey")
    return per_status.unionByName(bad.select(key).agg(*totals).select(F.lit("bad").alias("part"), "n_rows", "keys"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.user_device_counts(views.web_events(spark, sf_dir))


@query(
    "s2_user_device",
    using(
        """SELECT user_id, device_id, count(*) AS event_counts, count(DISTINCT host) AS n_hosts,
        string_agg(DISTINCT host, ',' ORDER BY host) AS host_array
        FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2""",
        "web_events",
    ),
)
def s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = web.user_device_hits(web.user_device_hosts(views.web_events(spark, sf_dir)))
    return rows.withColumn("host_array", F.array_join("host_array", ","))


@query(
    "s2_user_device_hosts",
    using(
        "SELECT user_id, device_id, host, count(*) AS hits FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2, 3",
        "web_events",
    ),
)
def s2_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.user_device_hosts(views.web_events(spark, sf_dir))


HITS = "(SELECT user_id, device_id, count(*) AS n FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)"


@query(
    "s3_users_devices",
    using(
        f"""SELECT user_id, max(n) AS total_hits, count(*) AS n_devices, CAST(sum(device_id) AS BIGINT) AS device_sum
        FROM {HITS} GROUP BY 1""",
        "web_events",
    ),
)
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.user_rollup(counts(spark, sf_dir))


@query(
    "s2_cached_rollups",
    using(
        f"""SELECT 'user' AS of, user_id AS id, max(n) AS most, count(*) AS n_pairs FROM {HITS} GROUP BY 2
        UNION ALL SELECT 'device', device_id, max(n), count(*) FROM {HITS} GROUP BY 2""",
        "web_events",
    ),
)
def s2_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate kept while two roll-ups are stored from it, then released."""
    with cached(counts(spark, sf_dir)) as hits:
        return files.stored(rollups(hits), "rollups")


def rollups(hits: DataFrame) -> DataFrame:
    """Largest hit count and number of pairs of each user and of each device."""
    measures = [F.max("event_counts").alias("most"), F.count(F.lit(1)).alias("n_pairs")]
    one = lambda key, name: hits.groupBy(F.col(key).alias("id")).agg(*measures).select(F.lit(name).alias("of"), "*")
    return one("user_id", "user").unionByName(one("device_id", "device"))


@query(
    "s3_device_lists",
    using(
        f"""SELECT user_id, CAST(floor(device_id / 1000) AS BIGINT) AS part,
        string_agg(CAST(device_id AS VARCHAR), ',' ORDER BY device_id) AS devices FROM {HITS} GROUP BY 1, 2""",
        "web_events",
    ),
)
def s3_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lists_by_range(counts(spark, sf_dir), ["user_id"], "device_id", "devices")
    return rows.withColumn("devices", F.array_join(F.col("devices").cast("array<string>"), ","))


@query(
    "s4_device_users",
    using(
        f"""SELECT device_id, device_type, count(*) AS n_users, CAST(sum(user_id) AS BIGINT) AS user_sum
        FROM {HITS} JOIN devices USING (device_id) GROUP BY 1, 2""",
        "web_events",
        "devices",
    ),
)
def s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.device_rollup(counts(spark, sf_dir), views.devices(spark, sf_dir))


@query(
    "s4_user_lists",
    using(
        f"""SELECT device_id, CAST(floor(user_id / 1000) AS BIGINT) AS part,
        string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS users FROM {HITS} GROUP BY 1, 2""",
        "web_events",
    ),
)
def s4_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lists_by_range(counts(spark, sf_dir), ["device_id"], "user_id", "users")
    return rows.withColumn("users", F.array_join(F.col("users").cast("array<string>"), ","))


EVENT_TIME = "strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time"


@query(
    "s5_enrich_typed",
    using(
        f"""SELECT event_id, user_id, device_id, upper(browser_type) AS browser_type, os_type, device_type,
        coalesce(referrer, 'unknown') AS referrer, host, url, ip, {EVENT_TIME}
        FROM web_events JOIN devices USING (device_id) WHERE user_id IS NOT NULL""",
        "web_events",
        "devices",
    ),
)
def s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.enrich_typed(views.web_events(spark, sf_dir), views.devices(spark, sf_dir))


@query(
    "s6_enrich_plain",
    using(
        f"""SELECT event_id, user_id, device_id, browser_type, os_type, device_type, referrer, host, url, ip, {EVENT_TIME}
        FROM web_events JOIN devices USING (device_id) WHERE user_id IS NOT NULL""",
        "web_events",
        "devices",
    ),
)
def s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.enrich_plain(views.web_events(spark, sf_dir), views.devices(spark, sf_dir))


@query(
    "s7_left_enrich",
    using(
        f"""SELECT event_id, user_id, device_id, browser_type AS browser_family, os_type AS os_family,
        device_type AS device_family, referrer, host, url, ip, {EVENT_TIME}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date
        FROM web_events LEFT JOIN devices USING (device_id)""",
        "web_events",
        "devices",
    ),
)
def s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.enrich_left(views.web_events(spark, sf_dir), views.devices(spark, sf_dir))


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.web_events(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))


@query(
    "s8_sorted_layout",
    using(
        """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows,
        min(host) AS first_host, max(host) AS last_host FROM web_events GROUP BY 1""",
        "web_events",
    ),
)
def s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days brought together and sorted by host within their partition, then read per day."""
    rows = layout.sorted_within(dated_events(spark, sf_dir), ["event_date"], ["event_date", "host", "event_time"])
    return rows.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("host").alias("first_host"), F.max("host").alias("last_host")
    )


@query(
    "s9_year_folders",
    """SELECT t AS table_name, year(o_orderdate) AS year, count(*) AS n_rows, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day
        FROM orders, (VALUES ('sorted'), ('plain')) v(t) GROUP BY 1, 2""",
)
def s9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies in yearly folders, one sorted inside, read back by folder."""
    rows = views.table(spark, sf_dir, "orders").withColumn("order_day", F.to_date("o_orderdate"))
    out = None
    for name, sort in (("plain", ()), ("sorted", ("order_day", "o_custkey"))):
        path = layout.write_by_year(rows, scratch_path(spark, name), "order_day", sort)
        one = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.min("order_day").alias("first_day"))
        one = one.select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


STAT_FILES = 8


@query(
    "s10_file_stats",
    using(
        f""", rated AS (SELECT *, CAST(event_time AS DATE) AS day, count(*) OVER () AS n FROM web_events),
        cut AS (SELECT 'sorted' AS table_name, host, day,
                (row_number() OVER (ORDER BY host, url, day, event_time, event_id) - 1) * {STAT_FILES} // n AS file FROM rated
            UNION ALL SELECT 'unsorted', host, day, (row_number() OVER (ORDER BY hash_of, event_time) - 1) * {STAT_FILES} // n
            FROM (SELECT *, md5(CAST(event_id AS VARCHAR)) AS hash_of FROM rated))
        SELECT table_name, count(*) AS n_files, CAST(sum(k) AS BIGINT) AS n_rows, count(*) FILTER ('h1' BETWEEN lo AND hi) AS files_h1,
        CASE table_name WHEN 'sorted' THEN 1 ELSE 2 END::BIGINT AS rank_by_bytes
        FROM (SELECT table_name, file, count(*) AS k, min(host) AS lo, max(host) AS hi FROM cut GROUP BY 1, 2) GROUP BY 1""",
        "web_events",
    ),
)
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted and an unsorted copy in as many files: the sorted one is smaller, and a filter opens fewer of its files."""
    rows = dated_events(spark, sf_dir).withColumn("hash_of", F.md5(F.col("event_id").cast("string")))
    orders = {"sorted": ["host", "url", "event_date", "event_time"], "unsorted": ["hash_of", "event_time"]}
    study = layout.layout_study(rows, orders, ["event_id"], {"files_h1": ("host", "h1")}, STAT_FILES)
    return study.drop("n_bytes")


LAYOUT_FILES = 32
LAYOUTS = {
    "playlist_map": ["playlist_id", "mapid", "completion_date"],
    "day": ["completion_date"],
    "interleaved": ["interleaved"],
    "match": ["match_id"],
}
MIXED = ("playlist_id", "mapid", "completion_date")
FILTERS = {
    "files_playlist": ("playlist_id", "3-MEDIUM"),
    "files_map": ("mapid", 7),
    "files_day": ("completion_date", date(1996, 3, 17)),
}


def layout_sql() -> str:
    """Files as equal stretches of a numbering, touched by their least and largest values; no parquet is involved."""
    number = {
        "playlist_id": "CAST('0x' || hex(encode(substr(playlist_id, 1, 5))) AS BIGINT)",
        "mapid": "CAST(mapid AS BIGINT)",
        "completion_date": "CAST(completion_date - DATE '1970-01-01' AS BIGINT)",
    }
    scaled = ", ".join(f"({v} - min({v}) OVER ()) * 31 // greatest(max({v}) OVER () - min({v}) OVER (), 1) AS z{i}" for i, v in enumerate(number.values()))
    mixed = " + ".join(f"(((z{i} >> {bit}) & 1) << {bit * 3 + 2 - i})" for i in range(3) for bit in range(5))
    tie = "match_id, player_gamertag, player_total_kills, player_total_deaths"
    parts = []
    for name, sort in LAYOUTS.items():
        ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in MIXED)
        text = {n: f"DATE '{v}'" if isinstance(v, date) else repr(v) for n, (_, v) in FILTERS.items()}
        hits = ", ".join(f"count(*) FILTER ({text[n]} BETWEEN lo_{c} AND hi_{c}) AS {n}" for n, (c, _) in FILTERS.items())
        parts.append(
            f"""SELECT '{name}' AS table_name, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_rows, {hits}
            FROM (SELECT file, count(*) AS n, {ends}
                  FROM (SELECT *, (row_number() OVER (ORDER BY {', '.join(sort)}, {tie}) - 1) * {LAYOUT_FILES} // count(*) OVER () AS file FROM mixed)
                  GROUP BY file)"""
        )
    return f""", scaled AS (SELECT *, {scaled} FROM match_details JOIN matches USING (match_id)),
        mixed AS (SELECT *, {mixed} AS interleaved FROM scaled) {' UNION ALL '.join(parts)}"""


@query("s11_layout_study", using(layout_sql(), "match_details", "matches"))
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rows under several sort orders, one of them interleaved, and how many files three filters touch in each."""
    return studied(spark, sf_dir).drop("n_bytes", "rank_by_bytes")


def studied(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.match_details(spark, sf_dir).join(views.matches(spark, sf_dir), "match_id")
    tie = ["match_id", "player_gamertag", "player_total_kills", "player_total_deaths"]
    return layout.layout_study(layout.interleaved(files.stored(rows, "matches-joined"), MIXED), LAYOUTS, tie, FILTERS, LAYOUT_FILES)


def match_files(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders")]


def stored_matches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Details and matches in buckets, stored once, ready to join without a shuffle."""

    def build() -> tuple[DataFrame, DataFrame]:
        details, games = views.match_details(spark, sf_dir), views.matches(spark, sf_dir)
        large, rest = layout.colocate(details, {"matches": (games, None)}, "match_id", ["player_gamertag"])
        return large, rest["matches"]

    return layout.stored_once(spark, ("matches",), match_files(sf_dir), build)


MATCH_COLUMNS = ("match_id", "player_gamertag", "player_total_kills", "player_total_deaths", "playlist_id", "mapid", "completion_date")
MATCH_SQL = """SELECT match_id, player_gamertag, CAST(player_total_kills AS BIGINT) AS player_total_kills,
        CAST(player_total_deaths AS BIGINT) AS player_total_deaths, playlist_id, mapid,
        CAST(completion_date AS VARCHAR) AS completion_date FROM match_details JOIN matches USING (match_id)"""


@query("s12_bucket_join", using(MATCH_SQL, "match_details", "matches"))
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    details, games = stored_matches(spark, sf_dir)
    return details.join(games, ["match_id", "part"]).select(*MATCH_COLUMNS)


def dated_matches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Details and matches with a folder per month and buckets of the match inside, in a session that prunes both."""

    def build() -> tuple[str, str]:
        games = views.matches(spark, sf_dir).withColumn("month", F.trunc("completion_date", "MM"))
        details = views.match_details(spark, sf_dir).join(games.select("match_id", "month"), "match_id", "left")
        large, rest = layout.colocate(details, {"matches": (games, None)}, "match_id", ["player_gamertag"], partition_by=["month"])
        return layout.table_name(large), layout.table_name(rest["matches"])

    other = layout.pruning_session(spark)
    details, games = layout.stored_once(spark, ("dated matches",), match_files(sf_dir), build)
    return other.table(details), other.table(games)


def in_month(details: DataFrame, games: DataFrame) -> DataFrame:
    """The join on match, part and month, without the month of the details twice."""
    return details.join(games, ["match_id", "part", "month"]).select(*MATCH_COLUMNS)


@query(
    "s17_partition_filter",
    using(f"{MATCH_SQL} WHERE date_trunc('month', completion_date) = DATE '1996-01-01'", "match_details", "matches"),
)
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month in the join condition: one folder of either table is read, and the join stays in place."""
    details, games = dated_matches(spark, sf_dir)
    return in_month(details, games.filter(F.col("month") == F.lit("1996-01-01").cast("date")))


@query(
    "s17_dynamic_pruning",
    using(
        f"""{MATCH_SQL} WHERE playlist_id = '1-URGENT' AND completion_date BETWEEN DATE '1996-03-10' AND DATE '1996-04-20'""",
        "match_details",
        "matches",
    ),
)
def s17_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on matches that names no folder: the months of what it leaves prune the details while the query runs."""
    details, games = dated_matches(spark, sf_dir)
    days = F.col("completion_date").between(F.lit(date(1996, 3, 10)), F.lit(date(1996, 4, 20)))
    return in_month(details, games.filter((F.col("playlist_id") == "1-URGENT") & days))


@query(
    "s14_kills",
    using(
        """SELECT player_gamertag, CAST(sum(player_total_kills) AS BIGINT) AS total_kills, count(DISTINCT match_id) AS n_matches,
        round(CAST(sum(player_total_kills) AS DOUBLE) / count(DISTINCT match_id), 6) AS kills_per_game FROM match_details GROUP BY 1""",
        "match_details",
    ),
)
def s14_kills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.kills_per_game(views.match_details(spark, sf_dir))


def matches_sql(column: str) -> str:
    return using(
        f"SELECT {column}, count(DISTINCT match_id) AS n_matches FROM match_details JOIN matches USING (match_id) GROUP BY 1",
        "match_details",
        "matches",
    )


@query("s14_playlist", matches_sql("playlist_id"))
def s14_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.matches_by(views.matches(spark, sf_dir), views.match_details(spark, sf_dir), "playlist_id")


@query(
    "s14_map",
    using(
        """SELECT n_name AS map_name, count(DISTINCT match_id) AS n_matches FROM match_details
        JOIN matches USING (match_id) JOIN nation ON n_nationkey = mapid GROUP BY 1""",
        "match_details",
        "matches",
    ),
)
def s14_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_map = matches.matches_by(views.matches(spark, sf_dir), views.match_details(spark, sf_dir), "mapid")
    return matches.name_maps(per_map, views.maps(spark, sf_dir))


MEDAL_MAP = """SELECT n_name AS map_name, 'Medal ' || lower(medal_id) AS medal, CAST(sum(count) AS BIGINT) AS n_medals
        FROM medals_players JOIN matches USING (match_id) JOIN nation ON n_nationkey = mapid GROUP BY 1, 2"""


def medal_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.medals_by_map(
        views.medals_players(spark, sf_dir),
        views.matches(spark, sf_dir),
        views.medals(spark, sf_dir),
        views.maps(spark, sf_dir),
    )


@query("s14_medal_map", using(MEDAL_MAP, "medals_players", "matches"))
def s14_medal_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medal_map(spark, sf_dir)


@query(
    "s14_three_way",
    using(
        """SELECT playlist_id, n_name AS map_name, 'Medal ' || lower(medal_id) AS medal, CAST(sum(n_medals) AS BIGINT) AS n_medals,
        CAST(sum(kills) AS BIGINT) AS kills, count(DISTINCT match_id) AS n_matches
        FROM (SELECT match_id, player_gamertag, sum(player_total_kills) AS kills FROM match_details GROUP BY 1, 2) d
        JOIN matches USING (match_id)
        JOIN (SELECT match_id, player_gamertag, medal_id, sum(count) AS n_medals FROM medals_players GROUP BY 1, 2, 3) w
          USING (match_id, player_gamertag)
        JOIN nation ON n_nationkey = mapid GROUP BY 1, 2, 3""",
        "match_details",
        "matches",
        "medals_players",
    ),
)
def s14_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details, matches and medals bucketed on the match and joined where they lie."""

    def build() -> tuple[DataFrame, DataFrame, DataFrame]:
        details = views.match_details(spark, sf_dir).groupBy("match_id", "player_gamertag").agg(
            F.sum("player_total_kills").alias("kills")
        )
        won = views.medals_players(spark, sf_dir).groupBy("match_id", "player_gamertag", "medal_id").agg(
            F.sum("count").alias("n_medals")
        )
        stored, rest = layout.colocate(
            details,
            {"matches": (views.matches(spark, sf_dir), None), "won": (won, ["player_gamertag"])},
            "match_id",
            ["player_gamertag"],
        )
        return stored, rest["matches"], rest["won"]

    tables = layout.stored_once(spark, ("match cube",), [*match_files(sf_dir), f"{sf_dir}/part.parquet"], build)
    return matches.match_cube(*tables, views.medals(spark, sf_dir), views.maps(spark, sf_dir))


@query(
    "s14_leaders",
    using(
        f"""SELECT * FROM (
        (SELECT 'player' AS question, player_gamertag AS winner,
                round(CAST(sum(player_total_kills) AS DOUBLE) / count(DISTINCT match_id), 6) AS amount
         FROM match_details GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL
        (SELECT 'playlist', playlist_id, CAST(count(DISTINCT match_id) AS DOUBLE) AS n
         FROM match_details JOIN matches USING (match_id) GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL
        (SELECT 'map', n_name, CAST(count(DISTINCT match_id) AS DOUBLE) AS n
         FROM match_details JOIN matches USING (match_id) JOIN nation ON n_nationkey = mapid GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL
        (SELECT 'medal map', map_name, CAST(n_medals AS DOUBLE) FROM ({MEDAL_MAP}) WHERE medal = 'Medal promo'
         ORDER BY 3 DESC, 2 LIMIT 1))""",
        "match_details",
        "matches",
        "medals_players",
    ),
)
def s14_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of each question; ties go to the smaller name."""
    details = views.match_details(spark, sf_dir)
    games = views.matches(spark, sf_dir)
    per_map = matches.name_maps(matches.matches_by(games, details, "mapid"), views.maps(spark, sf_dir))
    medal = medal_map(spark, sf_dir).filter(F.col("medal") == "Medal promo")
    asked = [
        ("player", matches.kills_per_game(details), "kills_per_game", "player_gamertag"),
        ("playlist", matches.matches_by(games, details, "playlist_id"), "n_matches", "playlist_id"),
        ("map", per_map, "n_matches", "map_name"),
        ("medal map", medal, "n_medals", "map_name"),
    ]
    out = None
    for question, df, value, name in asked:
        best = matches.top(df.withColumn(value, F.round(F.col(value).cast("double"), 6)), value, name)
        row = best.select(F.lit(question).alias("question"), F.col(name).alias("winner"), F.col(value).alias("amount"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "s15_staging",
    using(
        """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS ds, user_id, device_id, count(*) AS event_counts,
        count(DISTINCT host) AS n_hosts, string_agg(DISTINCT host, ',' ORDER BY host) AS host_array FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""",
        "web_events",
    ),
)
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table with an array column in daily folders, written and read back."""
    rows = views.web_events(spark, sf_dir).withColumn("ds", F.to_date("event_time").cast("string"))
    daily = web.user_device_hits(web.user_device_hosts(rows, "ds"), "ds")
    path = files.write_partitioned(daily, scratch_path(spark, "staging"), ["ds"])
    back = spark.read.schema(daily.schema).parquet(path)
    return back.withColumn("host_array", F.array_join("host_array", ","))


@query(
    "s16_vertex_job",
    """SELECT CAST(s_nationkey AS BIGINT) AS identifier, 'team' AS type, 'T' || s_nationkey AS abbreviation,
        min(s_name) AS nickname FROM supplier GROUP BY s_nationkey""",
)
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a stored table, build team vertices, overwrite the target."""
    source, target = scratch_path(spark, "teams"), scratch_path(spark, "vertices")
    views.teams(spark, sf_dir).write.parquet(source)
    run_job(spark, source, graph.team_vertices, target)
    props = [F.try_element_at("properties", F.lit(n)).alias(n) for n in ("abbreviation", "nickname")]
    return spark.read.parquet(target).select("identifier", "type", *props)


@query(
    "s18_date_key",
    "SELECT split_part(CAST(o_orderdate AS VARCHAR), ' ', 1) AS ds, count(*) AS n_matches FROM orders GROUP BY 1",
)
def s18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date key cut from the text of a timestamp."""
    stamp = views.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("string").alias("completed"))
    return stamp.groupBy(F.split_part("completed", F.lit(" "), F.lit(1)).alias("ds")).agg(F.count(F.lit(1)).alias("n_matches"))
