"""Daily ranges and previous-day values."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.operators import series
from quernel.plans.tables import table


def _observations(spark, folder):
    """Users as stations, clicks as highs, views as lows; very high values are flagged."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("station"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_type").alias("observation"),
        F.col("value"),
        F.when(F.col("value") > 300, F.lit("X")).alias("qflag"),
    )


def temp_range(spark, folder):
    obs = _observations(spark, folder)
    return series.largest_range(obs, "click", "view").orderBy("date", "station")


def temp_range_sql(spark, folder):
    return series.largest_range_sql(spark, _observations(spark, folder), "range_events", "click", "view")


def daily_maximum(spark, folder):
    """One row per user and day: the largest value."""
    events = table(spark, folder, "events")
    return events.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.max("value").alias("tmax"))


def _shown(days):
    return days.select(
        "user_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.dayofyear("date").cast("bigint").alias("dayofyear"),
        "tmax",
        "yesterday",
    )


def lag_day_join(spark, folder):
    return _shown(series.previous_day(daily_maximum(spark, folder), "user_id", "date", "tmax"))


def lag_day_window(spark, folder):
    return _shown(series.previous_day_window(daily_maximum(spark, folder), "user_id", "date", "tmax"))


QUERIES = {
    "temp_range": temp_range,
    "temp_range_sql": temp_range_sql,
    "lag_day_join": lag_day_join,
    "lag_day_window": lag_day_window,
}

_RANGE = """
WITH obs AS (
  SELECT user_id AS station, strftime(ts, '%Y-%m-%d') AS date, event_type, value
  FROM events WHERE value <= 300),
ranges AS (
  SELECT date, station, (hi - lo) / 10 AS range
  FROM (SELECT date, station, max(value) AS hi FROM obs WHERE event_type = 'click' GROUP BY ALL)
  JOIN (SELECT date, station, min(value) AS lo FROM obs WHERE event_type = 'view' GROUP BY ALL)
    USING (date, station))
SELECT date, station, range
FROM (SELECT *, rank() OVER (PARTITION BY date ORDER BY range DESC) AS place FROM ranges)
WHERE place = 1
"""

_LAG = """
WITH days AS (
  SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events GROUP BY ALL)
SELECT t.user_id, strftime(t.date, '%Y-%m-%d') AS date, CAST(dayofyear(t.date) AS BIGINT) AS dayofyear,
       t.tmax, y.tmax AS yesterday
FROM days AS t JOIN days AS y ON t.user_id = y.user_id AND t.date - 1 = y.date
"""

ORACLES = {
    "temp_range": _RANGE,
    "temp_range_sql": _RANGE,
    "lag_day_join": _LAG,
    "lag_day_window": _LAG,
}
