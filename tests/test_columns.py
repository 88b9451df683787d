import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwright.functions import columns as c


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected", [(1.005, 1.01), (0.285, 0.29), (2.345, 2.35), (-2.345, -2.35), (1.115, 1.12)]
)
def test_halves_round_away_from_zero(spark, value, expected):
    assert one(spark, c.round_half_up(F.lit(value))) == expected


def test_ratio_and_percent_without_denominator(spark):
    assert one(spark, c.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, c.percent(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, c.percent(F.lit(None).cast("int"), F.lit(3))) is None


def test_mean_skips_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (1, 3), (2, None)], "k int, v int")
    found = dict(df.groupBy("k").agg(c.mean(F.col("v"))).collect())
    assert found == {1: 2.5, 2: None}


def test_days_are_midnights_passed(spark):
    late, early = dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)
    df = spark.createDataFrame([(late, early)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(c.day_count(F.col("a"), F.col("b"))).first()[0] == 1


@pytest.mark.parametrize(
    "unit, expected",
    [
        ("week", dt.datetime(2024, 1, 29)),
        ("month", dt.datetime(2024, 2, 1)),
        ("quarter", dt.datetime(2024, 1, 1)),
        ("year", dt.datetime(2024, 1, 1)),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_period_start_in_any_zone(spark, unit, expected, zone):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 4, 23, 59),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert df.select(c.period_start(F.col("t"), unit)).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_key_tells_null_from_missing_and_empty(spark):
    data = [("a", None, "b"), ("a", "b", None), ("a", "b", ""), ("a", "", "b"), (None, "a", "b")]
    df = spark.createDataFrame(data, "x string, y string, z string")
    keys = df.select(c.surrogate_key(*[F.col(n) for n in "xyz"]).alias("k"))
    assert keys.distinct().count() == len(data)
    assert one(spark, c.surrogate_key(F.lit(1), F.lit("x"))) == one(spark, F.md5(F.lit("1-x")))


def test_cents(spark):
    assert str(one(spark, c.cents_to_dollars(F.lit(12345)))) == "123.45"
    assert str(one(spark, c.cents_to_dollars(F.lit(12345), 1))) == "123.5"
    assert str(one(spark, c.cents_to_dollars(F.lit(-5), 1))) == "-0.1"
