"""The views of ``views`` as DuckDB common table expressions for the comparison queries."""

from __future__ import annotations

from ledgerline.operators.facts import MEASURES

WEB_EVENTS = """
SELECT event_id, ts AS event_time,
       CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id,
       k AS device_id, '/' || event_type AS url, 'h' || (k % 3) AS host,
       '10.' || ((user_id // 256) % 256) || '.' || (user_id % 256) || '.' || (k % 4) AS ip,
       CASE event_id % 7
            WHEN 0 THEN 'https://www.linkedin.com/feed' WHEN 1 THEN 'https://t.co/abc'
            WHEN 2 THEN 'https://www.google.com/search' WHEN 3 THEN 'https://lnkd.in/xyz'
            WHEN 4 THEN 'https://news.example.org/today' WHEN 6 THEN 'https://blog.example.net' END AS referrer
FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events) e
JOIN (VALUES (1), (2)) c(n) ON c.n <= CASE WHEN event_id % 20 = 0 THEN 2 ELSE 1 END
"""

DEVICES = """
SELECT p_partkey AS device_id, p_brand AS browser_type, p_type AS device_type,
       CASE WHEN p_partkey % 10 <> 0 THEN 'os' || (p_size % 5) END AS os_type
FROM part
"""

PLAYER_SEASONS = """
SELECT c_name AS player_name, CAST(180 + c_custkey % 30 AS VARCHAR) AS height, c_mktsegment AS college,
       n_name AS country, CAST(1990 + c_custkey % 6 AS VARCHAR) AS draft_year,
       CAST(c_custkey % 2 + 1 AS VARCHAR) AS draft_round, CAST(c_custkey % 60 + 1 AS VARCHAR) AS draft_number,
       year(o_orderdate) AS season, count(*) AS gp,
       (CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // 20000) / 100.0::DOUBLE AS pts,
       count(*) FILTER (o_orderstatus = 'F') AS reb, count(*) FILTER (o_orderstatus = 'P') AS ast,
       count(*) FILTER (o_orderstatus = 'O') AS weight
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_name, c_custkey, c_mktsegment, n_name, year(o_orderdate)
"""

# One row per player and season from the first one to the last there is, with the latest season so far.
SNAPSHOTS = """
SELECT p.player_name, y.season AS current, s.season AS last_season, s.pts,
       CASE WHEN s.pts > 20 THEN 'star' WHEN s.pts > 15 THEN 'good' WHEN s.pts > 10 THEN 'average' ELSE 'bad' END AS class,
       s.season = y.season AS is_active
FROM (SELECT player_name, min(season) AS first_season FROM player_seasons GROUP BY 1) p
JOIN (SELECT unnest(generate_series(min(season), max(season))) AS season FROM player_seasons) y ON y.season >= p.first_season
JOIN player_seasons s ON s.player_name = p.player_name AND s.season <= y.season
QUALIFY row_number() OVER (PARTITION BY p.player_name, y.season ORDER BY s.season DESC) = 1
"""

ACTOR_FILMS = """
SELECT l_partkey AS actorid, l_orderkey || '-' || l_suppkey AS film, year(l_shipdate) AS year,
       CAST(l_quantity AS INTEGER) AS votes, CAST(round(l_discount * 100) AS INTEGER) AS rating,
       l_orderkey || '-' || l_suppkey || '-' || l_linenumber || '-' || CAST(l_quantity AS INTEGER) AS filmid
FROM lineitem
"""

ACTOR_YEARS = """
SELECT a.actorid, y.year AS current_year,
       CASE WHEN r.avg_rating > 8 THEN 'star' WHEN r.avg_rating > 7 THEN 'good'
            WHEN r.avg_rating > 6 THEN 'average' ELSE 'bad' END AS quality_class,
       r.year = y.year AS is_active
FROM (SELECT actorid, min(year) AS first_year FROM actor_films GROUP BY 1) a
JOIN (SELECT unnest(generate_series(min(year), max(year))) AS year FROM actor_films) y ON y.year >= a.first_year
JOIN (SELECT actorid, year, CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating FROM actor_films GROUP BY 1, 2) r
  ON r.actorid = a.actorid AND r.year <= y.year
QUALIFY row_number() OVER (PARTITION BY a.actorid, y.year ORDER BY r.year DESC) = 1
"""

TEAMS = """
SELECT CAST(s_nationkey AS BIGINT) AS team_id, 'T' || s_nationkey AS abbreviation, s_name AS nickname,
       n_name AS city, r_name AS arena, 1900 + s_nationkey AS yearfounded
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

GAMES = """
SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, year(o_orderdate) AS season,
       o_custkey % 25 AS home_team_id, (o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS visitor_team_id,
       CAST(CAST(floor(o_totalprice) AS BIGINT) % 2 AS INTEGER) AS home_team_wins,
       90 + (CAST(floor(o_totalprice) AS BIGINT) % 2) * 10 + o_orderkey % 7 AS pts_home,
       97 + o_orderkey % 3 AS pts_away
FROM orders
"""

GAME_DETAILS = """
SELECT game_id, team_id, 'T' || team_id AS team_abbreviation, l_partkey AS player_id, 'P' || l_partkey AS player_name,
       l_returnflag AS start_position,
       CASE l_suppkey % 10 WHEN 1 THEN 'DNP - Coach' WHEN 2 THEN 'DND - Injury' WHEN 3 THEN 'NWT - Personal' END AS comment,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN CAST(qty AS VARCHAR)
            ELSE qty || ':' || lpad(CAST(line * 7 AS VARCHAR), 2, '0') END AS min,
       qty // 3 AS fgm, qty // 2 AS fga, line % 4 AS fg3m, line % 4 + 2 AS fg3a, tax AS ftm, tax + 1 AS fta,
       line % 3 AS oreb, disc AS dreb, line % 3 + disc AS reb, line AS ast, l_suppkey % 4 AS stl, l_suppkey % 3 AS blk,
       l_suppkey % 6 AS turnovers, line % 6 AS pf, qty AS pts, qty - 25 AS plus_minus
FROM (SELECT *, l_linenumber AS line, CAST(l_quantity AS INTEGER) AS qty,
             CAST(round(l_discount * 100) AS INTEGER) AS disc, CAST(round(l_tax * 100) AS INTEGER) AS tax,
             CASE WHEN l_linenumber % 2 = 0 THEN visitor_team_id ELSE home_team_id END AS team_id
      FROM lineitem JOIN games ON l_orderkey = game_id) d
JOIN (VALUES (1), (2)) c(n) ON c.n <= CASE WHEN l_suppkey % 5 = 0 THEN 2 ELSE 1 END
"""

DETAIL_COLUMNS = (
    "game_id", "team_id", "team_abbreviation", "player_id", "player_name", "start_position", "comment", "min",
    "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "turnovers", "pf",
    "pts", "plus_minus",
)


def first_row(source: str, keys: list[str], columns: tuple[str, ...], order: tuple[str, ...] = ()) -> str:
    """Keep the smallest row per key by ``order`` and then all other columns, nulls first."""
    rest = [*order, *[c for c in columns if c not in keys and c not in order]]
    ranking = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ranking}) = 1"


# The order in which one of several rows of a player's game is picked.
PICK = ("team_id", "team_abbreviation", "pts", "start_position")

APPEARANCES = f"""
SELECT d.*, g.game_date, g.season, g.home_team_id, (d.team_id = g.home_team_id) = (g.home_team_wins = 1) AS won
FROM ({first_row("game_details", ["player_id", "game_id"], DETAIL_COLUMNS, PICK)}) d
JOIN games g USING (game_id)
"""

FACTS = f"""
SELECT d.game_id AS dim_game_id, g.game_date AS dim_game_date, g.season AS dim_season, d.team_id AS dim_team_id,
       d.player_id AS dim_player_id, d.player_name AS dim_player_name, d.start_position AS dim_start_position,
       d.team_id = g.home_team_id AS dim_is_playing_at_home,
       coalesce(contains(d.comment, 'DNP'), false) AS dim_did_not_play,
       coalesce(contains(d.comment, 'DND'), false) AS dim_did_not_dress,
       coalesce(contains(d.comment, 'NWT'), false) AS dim_not_with_team,
       TRY_CAST(split_part(d.min, ':', 1) AS DOUBLE)
         + coalesce(TRY_CAST(split_part(d.min, ':', 2) AS DOUBLE), 0.0::DOUBLE) / 60.0::DOUBLE AS m_minutes,
       {", ".join(f"{m} AS m_{m}" for m in MEASURES)}
FROM ({first_row("game_details", ["game_id", "team_id", "player_id"], DETAIL_COLUMNS)}) d
JOIN games g USING (game_id)
"""

MATCHES = """
SELECT o_orderkey AS match_id, o_orderstatus = 'F' AS is_team_game, o_orderpriority AS playlist_id,
       o_custkey % 25 AS mapid, CAST(o_orderdate AS DATE) AS completion_date
FROM orders
"""

MATCH_DETAILS = """
SELECT l_orderkey AS match_id, 'P' || l_partkey AS player_gamertag, CAST(l_quantity AS INTEGER) AS player_total_kills,
       l_linenumber AS player_total_deaths
FROM lineitem
"""

MEDALS_PLAYERS = """
SELECT l_orderkey AS match_id, 'P' || l_partkey AS player_gamertag, p_type AS medal_id, l_linenumber AS count
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

PURCHASES_BY_USER = """
SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents
FROM orders
"""

GEO_RANGES = """
SELECT CAST(10 * 256 * 256 * 256 AS BIGINT) + n_nationkey * 8 * 256 AS ip_from,
       CAST(10 * 256 * 256 * 256 AS BIGINT) + n_nationkey * 8 * 256 + 8 * 256 - 1 AS ip_to,
       n_name AS country, r_name AS state, 'city' || n_nationkey AS city
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 13
"""

GROWTH = """
SELECT user_id, d AS date, first_day, prev_last, is_on,
       CASE WHEN d = first_day THEN 'New'
            WHEN is_on AND prev_last = d - 1 THEN 'Retained'
            WHEN is_on AND prev_last < d - 1 THEN 'Resurrected'
            WHEN NOT is_on AND prev_last = d - 1 THEN 'Churned' ELSE 'Stale' END AS daily_active_state,
       CASE WHEN d = first_day THEN 'New'
            WHEN is_on AND prev_last < d - 7 THEN 'Resurrected'
            WHEN NOT is_on AND prev_last = d - 8 THEN 'Churned'
            WHEN CASE WHEN is_on THEN d ELSE prev_last END + 7 >= d - 1 THEN 'Retained' ELSE 'Stale' END AS weekly_active_state,
       CASE WHEN is_on THEN d ELSE prev_last END AS last_active_date, n_dates
FROM (
  SELECT g.user_id, g.d, g.first_day, a.day IS NOT NULL AS is_on,
         max(a.day) OVER (PARTITION BY g.user_id ORDER BY g.d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_last,
         count(a.day) OVER (PARTITION BY g.user_id ORDER BY g.d) AS n_dates
  FROM (SELECT user_id, first_day, CAST(unnest(generate_series(first_day, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT user_id, min(day) AS first_day FROM active_days GROUP BY 1)) g
  LEFT JOIN active_days a ON a.user_id = g.user_id AND a.day = g.d
) s
"""

BUYING_DAYS = """
SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events
WHERE user_id IS NOT NULL AND url = '/purchase'
"""

ACTIVE_DAYS = """
SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events WHERE user_id IS NOT NULL
"""

HITS = """
SELECT DISTINCT user_id, event_time, CAST(event_time AS DATE) AS day, url FROM web_events WHERE user_id IS NOT NULL
"""

# name -> (text, names of the views it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "web_events": (WEB_EVENTS, ()),
    "devices": (DEVICES, ()),
    "player_seasons": (PLAYER_SEASONS, ()),
    "snapshots": (SNAPSHOTS, ("player_seasons",)),
    "actor_films": (ACTOR_FILMS, ()),
    "actor_years": (ACTOR_YEARS, ("actor_films",)),
    "teams": (TEAMS, ()),
    "games": (GAMES, ()),
    "game_details": (GAME_DETAILS, ("games",)),
    "appearances": (APPEARANCES, ("games", "game_details")),
    "facts": (FACTS, ("games", "game_details")),
    "matches": (MATCHES, ()),
    "match_details": (MATCH_DETAILS, ()),
    "medals_players": (MEDALS_PLAYERS, ()),
    "purchases_by_user": (PURCHASES_BY_USER, ()),
    "geo_ranges": (GEO_RANGES, ()),
    "hits": (HITS, ("web_events",)),
    "buying_days": (BUYING_DAYS, ("web_events",)),
    "active_days": (ACTIVE_DAYS, ("web_events",)),
    "growth": (GROWTH, ("active_days", "web_events")),
    "buying_growth": (GROWTH.replace("active_days", "buying_days"), ("buying_days", "web_events")),
}


def using(body: str, *names: str) -> str:
    """``body`` preceded by the views it names and the views those need; it may begin with a comma and views of its own."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for inner in VIEWS[name][1]:
                add(inner)

    for name in names:
        add(name)
    parts = [f"{n} AS ({text.strip()})" for n, (text, _) in VIEWS.items() if n in wanted]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()
