"""Cumulative tables and type-2 histories."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import views
from ledgerline.catalog.registry import query
from ledgerline.catalog.sqlviews import using
from ledgerline.functions.columns import QUALITY_LADDER, SCORING_LADDER, ladder
from ledgerline.operators import dims, scd
from ledgerline.operators import stretches as stretches_of
from ledgerline.operators.grouping import dealt

# The last season and film year there are, in SQL.
LAST = "(SELECT max(season) FROM player_seasons)"
LAST_FILMS = "(SELECT max(year) FROM actor_films)"
STATICS = ("height", "college", "country", "draft_year", "draft_round", "draft_number")
HISTORY = ("season", "gp", "pts", "reb", "ast", "weight")
scoring = partial(ladder, steps=SCORING_LADDER)
quality = partial(ladder, steps=QUALITY_LADDER)


def last_season(spark: SparkSession, sf_dir: str) -> int:
    return views.last_year(spark, sf_dir, "orders", "o_orderdate")


def last_films(spark: SparkSession, sf_dir: str) -> int:
    return views.last_year(spark, sf_dir, "lineitem", "l_shipdate")


def history_until(spark: SparkSession, sf_dir: str, last: int) -> DataFrame:
    return history_of(views.player_seasons(spark, sf_dir), last)


def history_of(seasons: DataFrame, last: int) -> DataFrame:
    return dims.cumulate_backfill(seasons, "player_name", "season", last, STATICS, HISTORY, "pts", scoring)


def snapshot(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    rows = views.player_seasons(spark, sf_dir)
    return dims.cumulate_backfill(
        rows, "player_name", "season", year, STATICS, HISTORY, "pts", scoring, only_last=True
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots without their arrays, made and read on where a player's seasons are dealt to."""
    players = views.table(spark, sf_dir, "customer").count()
    seasons = dealt(views.player_seasons(spark, sf_dir), ["player_name"], players, dims.ENTITIES_PER_TASK)
    return history_of(seasons, last_season(spark, sf_dir)).select("player_name", "current", "class", "is_active")


def history_text() -> Column:
    entry = lambda s: F.concat_ws(
        ":", s["season"], s["gp"], F.round(s["pts"] * 100).cast("long"), s["reb"], s["ast"], s["weight"]
    )
    return F.concat_ws(",", F.transform("history", entry))


HISTORY_SQL = """string_agg(season || ':' || gp || ':' || CAST(round(pts * 100) AS BIGINT) || ':' || reb || ':' || ast
    || ':' || weight, ',' ORDER BY season)"""
CLASS_SQL = """CASE WHEN {0} > 20 THEN 'star' WHEN {0} > 15 THEN 'good' WHEN {0} > 10 THEN 'average' ELSE 'bad' END"""
QUALITY_SQL = """CASE WHEN {0} > 8 THEN 'star' WHEN {0} > 7 THEN 'good' WHEN {0} > 6 THEN 'average' ELSE 'bad' END"""

SHOWN = ("player_name", "height", "college", "country", "draft_year", "draft_round", "draft_number")


def shown(df: DataFrame) -> DataFrame:
    return df.select(
        *SHOWN,
        F.size("history").alias("n_seasons"),
        history_text().alias("seasons"),
        "class",
        "years_since_last_active",
        "is_active",
        "current",
    )


@query(
    "d1_cumulate_step",
    using(
        f"""SELECT player_name, height, college, country, draft_year, draft_round, draft_number,
        count(*) AS n_seasons, {HISTORY_SQL} AS seasons, {CLASS_SQL.format("arg_max(pts, season)")} AS class,
        1998 - max(season) AS years_since_last_active, max(season) = 1998 AS is_active, CAST(1998 AS BIGINT) AS current
        FROM player_seasons WHERE season <= 1998 GROUP BY ALL""",
        "player_seasons",
    ),
)
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year on top of the last partition of a stored table."""
    today = views.player_seasons(spark, sf_dir).filter(F.col("season") == 1998)
    prev = views.stored(spark, history_until(spark, sf_dir, 1997).filter("current >= 1996"), "players", "current")
    return shown(
        dims.cumulate_step(prev, today, "player_name", STATICS, HISTORY, "season", 1998, "pts", scoring)
    )


@query(
    "d2_cumulate_backfill",
    using(
        f"""SELECT s.player_name, height, college, country, draft_year, draft_round, draft_number,
        count(*) AS n_seasons, {HISTORY_SQL} AS seasons, {CLASS_SQL.format("arg_max(p.pts, p.season)")} AS class,
        current - max(season) AS years_since_last_active, max(season) = current AS is_active, current
        FROM (SELECT player_name, current FROM snapshots) s
        JOIN player_seasons p ON p.player_name = s.player_name AND p.season <= s.current
        GROUP BY s.player_name, height, college, country, draft_year, draft_round, draft_number, current""",
        "snapshots",
    ),
)
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history_until(spark, sf_dir, last_season(spark, sf_dir)))


@query(
    "d3_classify",
    using(
        f"SELECT season, {CLASS_SQL.format('pts')} AS class, count(*) AS n FROM player_seasons GROUP BY 1, 2",
        "player_seasons",
    ),
)
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.player_seasons(spark, sf_dir)
    return rows.groupBy("season", scoring(F.col("pts")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "d3b_quality_class",
    using(
        f"""SELECT actorid, year AS last_year, round(avg_rating, 6) AS avg_rating, {QUALITY_SQL.format("avg_rating")} AS quality_class
        FROM (SELECT actorid, year, CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating FROM actor_films GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY actorid ORDER BY year DESC) = 1""",
        "actor_films",
    ),
)
def d3b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.quality_class(views.actor_films(spark, sf_dir), "actorid", "year", "rating", quality)


@query(
    "d4_last_first_ratio",
    using(
        """SELECT player_name, round(arg_max(pts, season)
             / CASE WHEN arg_min(pts, season) = 0 THEN 1 ELSE arg_min(pts, season) END, 6) AS ratio
        FROM player_seasons GROUP BY 1""",
        "player_seasons",
    ),
)
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.last_to_first_ratio(snapshot(spark, sf_dir, last_season(spark, sf_dir)), "player_name", "pts")


@query(
    "d5_explode_history",
    using(
        "SELECT player_name, season, gp, pts, reb, ast, weight FROM player_seasons WHERE season <= 1998",
        "player_seasons",
    ),
)
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.explode_history(snapshot(spark, sf_dir, 1998), "player_name")


@query(
    "d6_change_indicators",
    using(
        """SELECT player_name, current, class, is_active, previous_class, previous_is_active,
        CAST(CASE WHEN rn = 1 OR class IS DISTINCT FROM previous_class THEN 1 ELSE 0 END AS BIGINT) AS class_changed,
        CAST(CASE WHEN rn = 1 OR is_active IS DISTINCT FROM previous_is_active THEN 1 ELSE 0 END AS BIGINT) AS is_active_changed
        FROM (SELECT *, lag(class) OVER w AS previous_class, lag(is_active) OVER w AS previous_is_active,
              row_number() OVER w AS rn FROM snapshots WINDOW w AS (PARTITION BY player_name ORDER BY current))""",
        "snapshots",
    ),
)
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.change_indicators(states(spark, sf_dir), "player_name", "current", ["class", "is_active"])


def stretches(source: str, key: str, period: str, tracked: list[str], until: int | str, stamp: bool = True) -> str:
    """Histories by the difference of two row numbers, another way than the operator's."""
    cols = ", ".join(tracked)
    current = f", CAST({until} AS BIGINT) AS current" if stamp else ""
    return f"""SELECT {key}, {cols}, min({period}) AS start_period, max({period}) AS end_period{current}
        FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {period})
                 - row_number() OVER (PARTITION BY {key}, {cols} ORDER BY {period}) AS grp
              FROM {source} WHERE {period} <= {until}) GROUP BY {key}, {cols}, grp"""


@query("d7_scd2_single", using(stretches("snapshots", "player_name", "current", ["class"], LAST, False), "snapshots"))
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_backfill(states(spark, sf_dir), "player_name", "current", ["class"])


@query(
    "d8_scd2_multi",
    using(stretches("snapshots", "player_name", "current", ["class", "is_active"], 2000), "snapshots"),
)
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_backfill(states(spark, sf_dir), "player_name", "current", ["class", "is_active"], 2000)


@query(
    "d9_scd2_compare",
    using(
        f"""SELECT c.player_name, c.class, c.is_active, o.class AS open_class, o.is_active AS open_is_active,
        o.start_period AS open_start, CASE WHEN o.player_name IS NULL THEN 'new'
            WHEN c.class IS DISTINCT FROM o.class OR c.is_active IS DISTINCT FROM o.is_active THEN 'changed'
            ELSE 'unchanged' END AS status
        FROM (SELECT * FROM snapshots WHERE current = {LAST}) c
        LEFT JOIN (SELECT * FROM ({stretches("snapshots", "player_name", "current", ["class", "is_active"], f"{LAST} - 1")})
                   WHERE end_period = {LAST} - 1) o ON o.player_name = c.player_name""",
        "snapshots",
    ),
)
def d9(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_states = states(spark, sf_dir)
    tracked, last = ["class", "is_active"], last_season(spark, sf_dir)
    history = scd.scd2_backfill(all_states, "player_name", "current", tracked, last - 1)
    return scd.scd2_compare(
        history.filter(F.col("end_period") == last - 1), all_states.filter(F.col("current") == last), "player_name", tracked
    )


@query(
    "d10_scd2_incremental",
    using(stretches("snapshots", "player_name", "current", ["class", "is_active"], LAST), "snapshots"),
)
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot on top of a stored table of three."""
    all_states = states(spark, sf_dir)
    tracked, last = ["class", "is_active"], last_season(spark, sf_dir)
    before = stored_histories(spark, all_states, "player_name", "current", tracked, last)
    return scd.scd2_incremental(before, all_states, "player_name", "current", tracked, last)


def stored_histories(spark: SparkSession, rows: DataFrame, key: str, period: str, tracked: list[str], last: int) -> DataFrame:
    """Histories as of the three years before ``last``, one partition each."""
    out = None
    for year in range(last - 3, last):
        one = scd.scd2_backfill(rows, key, period, tracked, year)
        out = one if out is None else out.unionByName(one)
    return views.stored(spark, out, "histories", "current")


FILM = ("film", "votes", "rating", "filmid")
FILMS_A_STRETCH = 16


def films_text() -> Column:
    entry = lambda f: F.concat_ws(":", f["year"], f["film"], f["votes"], f["rating"], f["filmid"])
    return F.concat_ws(",", F.transform("items", entry))


@query(
    "d12_actors_cumulative",
    using(
        f"""SELECT f.actorid, f.stretch, f.n_films, f.films, {QUALITY_SQL.format("y.avg_rating")} AS quality_class,
        y.year = t.top AS is_active, t.top AS current_year
        FROM (SELECT actorid, (place - 1) // {FILMS_A_STRETCH} AS stretch, count(*) AS n_films,
                     string_agg(year || ':' || film || ':' || votes || ':' || rating || ':' || filmid, ',' ORDER BY place) AS films
              FROM (SELECT *, row_number() OVER (PARTITION BY actorid ORDER BY year, film, votes, rating, filmid) AS place FROM actor_films)
              GROUP BY 1, 2) f
        JOIN (SELECT actorid, year, CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating FROM actor_films GROUP BY 1, 2
              QUALIFY row_number() OVER (PARTITION BY actorid ORDER BY year DESC) = 1) y ON y.actorid = f.actorid
        CROSS JOIN (SELECT max(year) AS top FROM actor_films) t""",
        "actor_films",
    ),
)
def d12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every film of every actor: the latest year on top of stored stretches and the snapshots of two years."""
    films = views.actor_films(spark, sf_dir)
    latest = last_films(spark, sf_dir)
    args = ("actorid", "year", FILM, "rating")
    before = [stretches_of.history_backfill(films, *args, y, quality, FILMS_A_STRETCH) for y in (latest - 2, latest - 1)]
    snapshots = views.stored(spark, before[0][1].unionByName(before[1][1]), "actors", "current")
    closed, snapshot = stretches_of.history_step(snapshots, films, *args, latest, quality, FILMS_A_STRETCH)
    history = views.stored(spark, before[1][0].unionByName(closed), "actors-films", "closed_in")
    rows = stretches_of.whole_history(history, snapshot, "actorid", latest, FILMS_A_STRETCH)
    return rows.select(
        "actorid", "stretch", F.size("items").alias("n_films"), films_text().alias("films"),
        "quality_class", "is_active", F.col("current").alias("current_year"),
    )


@query(
    "d12_actors_totals",
    using(
        """SELECT f.actorid, f.n_films, f.votes, f.ratings, f.first_film, f.last_film, y.quality_class, y.is_active, y.current_year
        FROM (SELECT actorid, count(*) AS n_films, CAST(sum(votes) AS BIGINT) AS votes, CAST(sum(rating) AS BIGINT) AS ratings,
                     min(filmid) AS first_film, max(filmid) AS last_film
              FROM actor_films WHERE year <= 1998 GROUP BY 1) f
        JOIN actor_years y ON y.actorid = f.actorid AND y.current_year = 1998""",
        "actor_years",
    ),
)
def d12_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year on top of the last partition of a stored table."""
    films = views.actor_films(spark, sf_dir)
    totals = {
        "sums": {"votes": "votes", "rating": "ratings"},
        "ends": {"filmid": ("first_film", "last_film")},
        "count": "n_films",
    }
    earlier = [dims.films_totals(films, "actorid", "year", "rating", y, quality, **totals) for y in (1996, 1997)]
    prev = views.stored(spark, earlier[0].unionByName(earlier[1]), "actors", "current_year")
    now = dims.films_totals_step(prev, films, "actorid", "year", "rating", 1998, quality, **totals)
    return now.select(
        "actorid", "quality_class", "is_active", "current_year", "n_films", "votes", "ratings", "first_film", "last_film"
    )


def actor_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    films = views.actor_films(spark, sf_dir)
    actors = views.table(spark, sf_dir, "part").count()
    return dims.yearly_quality(films, "actorid", "year", "rating", last_films(spark, sf_dir), quality, actors)


TRACKED = ["quality_class", "is_active"]


@query("d13_actors_scd", using(stretches("actor_years", "actorid", "current_year", TRACKED, 2000), "actor_years"))
def d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_backfill(actor_states(spark, sf_dir), "actorid", "current_year", TRACKED, 2000)


@query("d14_actors_scd_incr", using(stretches("actor_years", "actorid", "current_year", TRACKED, LAST_FILMS), "actor_years"))
def d14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = actor_states(spark, sf_dir)
    last = last_films(spark, sf_dir)
    before = stored_histories(spark, rows, "actorid", "current_year", TRACKED, last)
    return scd.scd2_incremental(before, rows, "actorid", "current_year", TRACKED, last)
