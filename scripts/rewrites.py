"""Time four hand rewrites against the plain formulation of the same result.

    python scripts/rewrites.py [sf_dir] [cores]

Both sides read the same tables and must return the same number of rows.
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.catalog import q_dims, views  # noqa: E402
from ledgerline.operators import activity, patterns, scd  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

AS_OF = date(2024, 1, 30)


def funnel_pair(spark, sf_dir):
    """Every event against every later one of its user and day."""
    events = views.web_events(spark, sf_dir)
    hits = events.filter("user_id IS NOT NULL").select("user_id", "event_time", "url").distinct()
    hits = hits.withColumn("day", F.to_date("event_time"))
    later = hits.select("user_id", "day", F.col("event_time").alias("then"), F.col("url").alias("target"))
    pairs = hits.join(later, ["user_id", "day"]).filter(F.col("then") > F.col("event_time"))
    per_event = pairs.groupBy("user_id", "event_time", "url").agg(F.max(F.col("target") == "/signup").alias("hit"))
    plain = per_event.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits")).filter("hits > 0")
    return plain, patterns.funnel(events, "user_id", "event_time", "url", "/signup")


def datelist_pair(spark, sf_dir):
    """Every user against every one of 32 days."""
    lists = activity.active_dates_backfill(views.web_events(spark, sf_dir), ["user_id"], "event_time", AS_OF)
    days = spark.range(32).select(F.date_sub(F.lit(AS_OF), F.col("id").cast("int")).alias("day"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), 31 - F.datediff(F.lit(AS_OF), "day"))
    active = F.when(F.array_contains("dates_active", F.col("day")), bit).otherwise(0)
    plain = lists.crossJoin(days).groupBy("user_id").agg(F.sum(active).alias("datelist_int"))
    return plain, activity.datelist(lists, AS_OF)


def spine_pair(spark, sf_dir):
    """A calendar joined by inequality, then a window that collects."""
    seasons = views.player_seasons(spark, sf_dir)
    spans = seasons.groupBy("player_name").agg(
        F.min("season").alias("first"), *[F.max(c).alias(c) for c in q_dims.STATICS]
    )
    last = q_dims.last_season(spark, sf_dir)
    calendar = spark.range(last - 6, last + 1).select(F.col("id").cast("int").alias("season"))
    grid = spans.join(calendar, F.col("first") <= F.col("season"))
    facts = seasons.select("player_name", "season", F.struct(*q_dims.HISTORY).alias("entry"))
    order = Window.partitionBy("player_name").orderBy("season")
    plain = grid.join(facts, ["player_name", "season"], "left").withColumn("history", F.collect_list("entry").over(order))
    return plain, q_dims.history_until(spark, sf_dir, last)


def incremental_pair(spark, sf_dir):
    """One join for each kind of record."""
    states = q_dims.states(spark, sf_dir).persist()
    tracked = ["class", "is_active"]
    before = scd.scd2_backfill(states, "player_name", "current", tracked, 2000).persist()
    states.count(), before.count()
    n = states.filter("current = 2001").alias("n")
    o = before.filter("end_period = 2000").select("player_name", *tracked, "start_period").alias("o")
    both = F.col("n.player_name") == F.col("o.player_name")
    equal = (F.col("n.class") == F.col("o.class")) & (F.col("n.is_active") == F.col("o.is_active"))
    now = [F.col("n.player_name"), F.col("n.class"), F.col("n.is_active")]
    was = [F.col("o.player_name"), F.col("o.class"), F.col("o.is_active")]
    this, start = F.lit(2001), F.col("o.start_period")
    parts = [
        before.filter("end_period < 2000").select("player_name", *tracked, "start_period", "end_period"),
        n.join(o, both & equal).select(*now, start, this),
        n.join(o, both & ~equal).select(
            F.inline(F.array(F.struct(*was, start, F.lit(2000)), F.struct(*now, this.alias("start_period"), this)))
        ),
        n.join(o, both, "left_anti").select(*now, this, this),
    ]
    plain = parts[0]
    for part in parts[1:]:
        plain = plain.union(part)
    return plain, scd.scd2_incremental(before, states, "player_name", "current", tracked, 2001)


PAIRS = {
    "R1 funnel: self-join / slices": funnel_pair,
    "R2 datelist: cross join / per-row bits": datelist_pair,
    "R3 entity x period: theta join / filled arrays": spine_pair,
    "R4 incremental history: three joins / one": incremental_pair,
}


def seconds(df, runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return statistics.median(times[1:])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("rewrites", cores=sys.argv[2] if len(sys.argv) > 2 else 4)
    for name, make in PAIRS.items():
        plain, ours = make(spark, sf_dir)
        rows = (plain.count(), ours.count())
        a, b = seconds(plain), seconds(ours)
        print(f"{name}: {a:.3f} s / {b:.3f} s = {a / b:.2f}, rows {rows[0]} / {rows[1]}", flush=True)


if __name__ == "__main__":
    main()
