"""Column helpers against plain Python."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions import numeric as num
from basketry.functions import segments, text

MOMENTS = [dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 23, 59, 59, 999999), dt.datetime(2024, 3, 10, 2, 30),
           dt.datetime(2023, 12, 31, 12), dt.datetime(2024, 1, 1, 5, 59, 59), dt.datetime(2024, 7, 1, 22)]


@pytest.fixture
def moments(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(MOMENTS)], "i int, ts timestamp_ntz").orderBy("i")


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=50))
def test_cents_and_units_are_exact(spark, values):
    df = spark.createDataFrame([(v, v / 100.0) for v in values], "c long, x double")
    assert column(df, num.cents("x")) == values
    assert column(df, num.units("c")) == [Decimal(v) / 100 for v in values]
    assert df.agg(num.sum_money("c")).first()[0] == Decimal(sum(values)) / 100


def test_rounding_and_rates(spark):
    df = spark.createDataFrame([(0.125, 1), (2.5, 0), (99.95, 4)], "x double, n int")
    assert column(df, num.half_up("x", 2)) == [0.13, 2.5, 99.95]
    assert column(df, num.half_up("x", 0)) == [0.0, 3.0, 100.0]
    assert column(df, num.ratio("x", "n"))[1] is None
    assert df.agg(num.rate_of(F.col("n") > 0)).first()[0] == 66.7


def test_standard_deviation(spark):
    def spread(values):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        return df.agg(num.sample_stddev(F.count("v"), F.sum("v"), F.sum(F.col("v") * F.col("v")))).first()[0]

    assert spread([2, 4, 4, 4, 5, 5, 7, 9]) == pytest.approx(2.13809, abs=1e-5)
    assert spread([5]) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_helpers_do_not_depend_on_the_zone(spark, moments, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        epoch = dt.datetime(1970, 1, 1)
        assert column(moments, cal.epoch_micros("ts")) == [(t - epoch) // dt.timedelta(microseconds=1) for t in MOMENTS]
        assert column(moments, cal.epoch_millis("ts")) == [(t - epoch) // dt.timedelta(milliseconds=1) for t in MOMENTS]
        assert column(moments, cal.week_start("ts")) == [t.date() - dt.timedelta(days=t.weekday()) for t in MOMENTS]
        assert column(moments, cal.year_month("ts")) == [t.strftime("%Y-%m") for t in MOMENTS]
        iso = moments.withColumn("iso", cal.iso_text("ts"))
        assert column(iso, "iso") == [t.strftime("%Y-%m-%dT%H:%M:%SZ") for t in MOMENTS]
        assert column(iso, cal.parse_iso("iso")) == [t.replace(microsecond=0) for t in MOMENTS]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_buckets(spark, moments):
    assert column(moments, cal.time_of_day(F.hour("ts"))) == ["night", "night", "night", "afternoon", "night", "night"]
    df = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2023, 12, 31)), (dt.date(2024, 3, 31), dt.date(2024, 3, 1))], "a date, b date")
    assert column(df, cal.months_apart(F.col("a"), F.col("b"))) == [3, 0]
    start = moments.withColumn("start", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    assert column(start, cal.seconds_between("start", "ts")) == [int((t - MOMENTS[0]).total_seconds()) for t in MOMENTS]
    days = [t.date() for t in MOMENTS]
    kept = cal.by_date(moments, dt.date(2023, 12, 31), dt.date(2024, 2, 29), "ts")
    assert kept.count() == sum(dt.date(2023, 12, 31) <= d <= dt.date(2024, 2, 29) for d in days)


def test_row_keys_sort_newest_first(spark):
    df = spark.createDataFrame([("a_b", t) for t in MOMENTS], "user string, ts timestamp_ntz").withColumn("key", cal.session_row_key("user", "ts"))
    assert column(df.orderBy("key"), "ts") == sorted(MOMENTS, reverse=True)
    assert set(column(df, cal.row_key_user("key"))) == {"a_b"}


def test_tiers(spark):
    df = spark.createDataFrame([(5000.0,), (4999.99,), (2000.0,), (500.0,), (499.99,), (None,)], "v double")
    assert column(df, segments.clv_tier(F.col("v"))) == ["Platinum", "Gold", "Gold", "Silver", "Bronze", "Bronze"]
    assert column(df, segments.segment_rank(F.lit("Low"))) == [3] * 6


def test_text(spark):
    df = spark.createDataFrame([("Blue Ring", 1234567.4), (None, 0.5)], "name string, n double")
    assert column(df, text.contains_ignore_case("name", "RING")) == [True, False]
    assert column(df, text.thousands("n"))[0] == "1,234,567"
    assert column(df, text.share_label(F.lit(3), F.lit(12.5)))[0] == "3 (12.5%)"
