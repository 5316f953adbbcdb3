from __future__ import annotations

from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from ledgerline.functions import columns as c


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_ladder_bounds_are_exclusive_and_null_is_lowest(spark):
    df = spark.createDataFrame([(20.1,), (20.0,), (15.0,), (10.0,), (None,)], "v double")
    got = [r["k"] for r in df.select(c.ladder(F.col("v"), c.SCORING_LADDER).alias("k")).collect()]
    assert got == ["star", "good", "average", "bad", "bad"]


def test_class_rank_orders_labels(spark):
    df = spark.createDataFrame([("star",), ("bad",), ("other",)], "k string")
    assert [r[0] for r in df.select(c.class_rank(F.col("k"))).collect()] == [3, 0, None]


def test_clock_minutes(spark):
    df = spark.createDataFrame([("12:30",), ("12",), ("12:xx",), (None,), ("a:1",)], "m string")
    assert [r[0] for r in df.select(c.clock_minutes(F.col("m"))).collect()] == [12.5, 12.0, 12.0, None, None]


def test_mentions_null_is_false(spark):
    df = spark.createDataFrame([("DNP - x",), ("ok",), (None,)], "t string")
    assert [r[0] for r in df.select(c.mentions(F.col("t"), "DNP")).collect()] == [True, False, False]


def test_channel_order_matters(spark):
    df = spark.createDataFrame([("https://t.co/google",), ("https://at.company.io",), ("x",), (None,)], "r string")
    # The second host holds "t.co" by accident; the rules are substrings.
    assert [r[0] for r in df.select(c.channel(F.col("r"))).collect()] == ["Twitter", "Twitter", "x", None]


def test_today_is_the_highest_bit(spark):
    dates = F.array(F.lit(date(2024, 1, 30)), F.lit(date(2024, 1, 29)))
    assert one(spark, c.bits_of_dates(dates, F.lit(date(2024, 1, 30)))) == 3221225472
    assert one(spark, c.days_in_mask(F.lit(3221225472), c.DAY_MASK)) == 1


def test_masks_do_not_overlap():
    assert bin(c.WEEK_MASK).count("1") == 7
    assert bin(c.PREVIOUS_WEEK_MASK).count("1") == 7
    assert c.WEEK_MASK & c.PREVIOUS_WEEK_MASK == 0
    assert c.DAY_MASK & c.WEEK_MASK == c.DAY_MASK


def test_old_and_future_dates_set_no_bit(spark):
    dates = F.array(F.lit(date(2023, 12, 1)), F.lit(date(2024, 2, 1)), F.lit(date(2023, 12, 30)))
    assert one(spark, c.bits_of_dates(dates, F.lit(date(2024, 1, 30)))) == 1


@settings(max_examples=15, deadline=None)
@given(st.sets(st.dates(date(2023, 12, 30), date(2024, 1, 30)), max_size=32))
def test_bits_round_trip(spark, days):
    as_of = F.lit(date(2024, 1, 30))
    df = spark.createDataFrame([(sorted(days),)], "d array<date>")
    back = df.select(c.dates_of_bits(c.bits_of_dates(F.col("d"), as_of), as_of).alias("d")).first()["d"]
    assert back == sorted(days)


def test_ip_number(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("1.2.3",), ("a.b.c.d",), (None,)], "ip string")
    assert rows(df.select(c.ip_number(F.col("ip")).alias("n")).filter("n is not null")) == [(167772161,)]


def test_hash_percent_is_stable(spark):
    a = spark.range(50).select(c.hash_percent("s", F.col("id")).alias("p")).collect()
    b = spark.range(50).repartition(5).select(c.hash_percent("s", F.col("id")).alias("p")).collect()
    assert sorted(a) == sorted(b)
    assert all(0 <= r["p"] < 100 for r in a)
