import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quernel.operators import routing, series, stats

SCHEMA = "station string, date string, observation string, value int, qflag string"


@pytest.fixture
def obs(spark):
    data = [
        ("CA1", "d1", "TMAX", 200, None),
        ("CA1", "d1", "TMIN", 100, None),
        ("CA2", "d1", "TMAX", 150, None),
        ("CA2", "d1", "TMIN", 50, None),
        ("CA2", "d1", "TMAX", 150, None),
        ("US1", "d1", "TMAX", 90, None),
        ("US2", "d1", "TMAX", 900, "X"),
        ("US2", "d1", "TMIN", 0, None),
        ("CA1", "d2", "TMAX", 10, None),
        ("CA1", "d2", "TMIN", 15, None),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_largest_range(spark, obs):
    expected = [("d1", "CA1", 10.0), ("d1", "CA2", 10.0), ("d2", "CA1", -0.5)]
    assert rows(series.largest_range(obs)) == expected
    assert rows(series.largest_range_sql(spark, obs)) == expected


def test_largest_range_equals_the_join_of_highs_and_lows(spark, obs):
    valid = obs.where("qflag is null")
    high = valid.where("observation = 'TMAX'").select("date", "station", F.col("value").alias("h"))
    low = valid.where("observation = 'TMIN'").select("date", "station", F.col("value").alias("l"))
    pairs = high.join(low, ["date", "station"]).select("date", "station", ((F.col("h") - F.col("l")) / 10).alias("range"))
    tops = pairs.groupBy("date").agg(F.max("range").alias("range"))
    assert rows(series.largest_range(obs)) == rows(pairs.join(tops, ["date", "range"]).distinct(), "date", "station", "range")


def test_valid_observations(obs):
    assert rows(routing.valid_observations(obs)) == [
        ("CA1", "d1", 20.0),
        ("CA1", "d2", 1.0),
        ("CA2", "d1", 15.0),
        ("CA2", "d1", 15.0),
    ]


def days(spark, *rows_):
    return spark.createDataFrame(
        [(s, datetime.date.fromisoformat(d), v) for s, d, v in rows_], "s string, d date, v double"
    )


@pytest.mark.parametrize("form", [series.previous_day, series.previous_day_window])
def test_previous_day(spark, form):
    df = days(
        spark,
        ("a", "2019-12-31", 1.0),
        ("a", "2020-01-01", 2.0),
        ("a", "2020-01-03", 3.0),
        ("b", "2020-01-02", 9.0),
        ("c", "2020-02-28", 1.0),
        ("c", "2020-02-29", None),
        ("c", "2020-03-01", 5.0),
    )
    got = [(r.s, str(r.d), r.v, r.yesterday) for r in form(df, "s", "d", "v").orderBy("s", "d").collect()]
    assert got == [("a", "2020-01-01", 2.0, 1.0), ("c", "2020-02-29", None, 1.0), ("c", "2020-03-01", 5.0, None)]


def test_previous_day_forms_agree_across_spans(spark):
    """Five hundred days before and after 1970 cross many spans; every 9th day is missing."""
    df = spark.range(-250, 250).where("id % 9 <> 0").select(
        F.lit("a").alias("s"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id").cast("double").alias("v")
    )
    one = rows(series.previous_day(df, "s", "d", "v"))
    assert one == rows(series.previous_day_window(df, "s", "d", "v"))
    assert all(v - y == 1 for _, _, v, y in one) and len(one) > 300


def points(spark, *pairs):
    return spark.createDataFrame(list(pairs), "x double, y double")


def test_pearson(spark):
    xy = points(spark, (1.0, 2.0), (2.0, 3.0), (3.0, 7.0), (None, 4.0), (5.0, None))
    by_moments, by_sums = stats.pearson(xy).first(), stats.pearson_of_sums(stats.power_sums(xy)).first()
    assert by_moments.r == pytest.approx(0.9449111825230679)
    assert by_sums.r == pytest.approx(by_moments.r) and by_sums.r2 == pytest.approx(by_moments.r2)


@pytest.mark.parametrize("pairs", [[(1.0, 2.0), (1.0, 3.0)], [(1.0, 2.0)], [(1.0, 5.0), (2.0, 5.0)]])
def test_pearson_of_a_constant_is_null(spark, pairs):
    xy = points(spark, *pairs)
    assert stats.pearson(xy).first().r is None
    assert stats.pearson_of_sums(stats.power_sums(xy)).first().r is None


def test_pearson_keeps_digits_of_large_values(spark):
    xy = spark.range(1000).select(
        (F.col("id") + 1e9).cast("double").alias("x"), (F.col("id") * 2 + 1e12).cast("double").alias("y")
    )
    assert stats.pearson(xy).first().r == pytest.approx(1.0)


def test_lines(spark):
    xy = points(spark, (1.0, 3.0), (2.0, 5.0), (3.0, 7.0))
    assert tuple(stats.fitted_line(xy).first()) == pytest.approx((2.0, 1.0))
    assert tuple(stats.line_of_sums(stats.power_sums(xy)).first()) == pytest.approx((2.0, 1.0))
    one = points(spark, (1.0, 3.0))
    assert stats.fitted_line(one).first().beta is None
    assert stats.line_of_sums(stats.power_sums(one)).first().beta is None
