"""Daily series: previous-day values and daily ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernel.operators.topgroup import top_rows
from quernel.session import materialize

# Days per window of previous_day_window. One row per station and day makes
# this the most rows a task sorts as one group.
SPAN_DAYS = 64


def previous_day(
    df: DataFrame, station: str, day: str, value: str, out: str = "yesterday"
) -> DataFrame:
    """Add the value of exactly the day before; days without one drop out.

    For one row per station and day, which also spreads a long series evenly.
    """
    before = df.select(
        F.col(station), F.date_add(day, 1).alias(day), F.col(value).alias(out)
    )
    return df.join(before, [station, day]).select(*df.columns, out)


def previous_day_window(
    df: DataFrame, station: str, day: str, value: str, out: str = "yesterday"
) -> DataFrame:
    """The same by a window, for one row per station and day: one shuffle, not two.

    A long series is cut into spans of days; the last day of a span is also
    sent to the next one, where it only serves as the day before.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    span = F.floor(number / SPAN_DAYS)
    ends = F.pmod(number, F.lit(SPAN_DAYS)) == SPAN_DAYS - 1
    copies = F.when(ends, F.array(span, span + 1)).otherwise(F.array(span))
    spread = df.select("*", span.alias("_own"), F.explode(copies).alias("_span"))
    in_span = Window.partitionBy(station, "_span").orderBy(day)
    return (
        spread.withColumn(out, F.lag(value).over(in_span))
        .withColumn("_day", F.lag(day).over(in_span))
        .where((F.col("_own") == F.col("_span")) & (F.datediff(F.col(day), F.col("_day")) == 1))
        .select(*df.columns, out)
    )


def daily_extremes(
    obs: DataFrame, high: str = "TMAX", low: str = "TMIN", scale: float = 10
) -> DataFrame:
    """``date, station, range``: highest ``high`` less lowest ``low``, where both exist.

    One aggregate over one scan. A station that reports a day twice gives its
    widest range once.
    """
    kind, value = F.col("observation"), F.col("value")
    pairs = (
        obs.where(kind.isin(high, low))
        .groupBy("date", "station")
        .agg(
            F.max(F.when(kind == high, value)).alias("_high"),
            F.min(F.when(kind == low, value)).alias("_low"),
        )
    )
    ranges = (F.col("_high") - F.col("_low")) / scale
    return pairs.select("date", "station", ranges.alias("range")).where(F.col("range").isNotNull())


def largest_range(
    obs: DataFrame, high: str = "TMAX", low: str = "TMIN", scale: float = 10
) -> DataFrame:
    """Stations with the largest range of each day, all ties, unflagged values only."""
    valid = obs.where(F.col("qflag").isNull())
    ranges = materialize(daily_extremes(valid, high, low, scale), "ranges")
    return top_rows(ranges, "date", "range")


LARGEST_RANGE_SQL = """
WITH pairs AS (
  SELECT date, station,
         max(value) FILTER (WHERE observation = '{high}') AS high,
         min(value) FILTER (WHERE observation = '{low}') AS low
  FROM {view}
  WHERE qflag IS NULL AND observation IN ('{high}', '{low}')
  GROUP BY date, station),
ranges AS (
  SELECT date, station, (high - low) / {scale} AS range
  FROM pairs WHERE high IS NOT NULL AND low IS NOT NULL),
tops AS (
  SELECT date, max(range) AS range FROM ranges GROUP BY date)
SELECT ranges.date, ranges.station, ranges.range
FROM ranges JOIN tops ON ranges.date = tops.date AND ranges.range = tops.range
"""


def largest_range_sql(
    spark: SparkSession, obs: DataFrame, view: str = "observations", high="TMAX", low="TMIN", scale=10
) -> DataFrame:
    """The same in SQL text over a view."""
    obs.createOrReplaceTempView(view)
    return spark.sql(LARGEST_RANGE_SQL.format(view=view, high=high, low=low, scale=scale))
