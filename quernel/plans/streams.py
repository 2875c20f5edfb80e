"""Least-squares line over events read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.plans.tables import table
from quernel.streaming import line


def _messages(spark, folder):
    """Events as binary ``"user value"`` messages."""
    schema = table(spark, folder, "events").schema
    stream = line.open_stream(spark, "parquet", folder, schema, pathGlobFilter="events.parquet")
    return stream.select(F.encode(F.concat_ws(" ", "user_id", "value"), "utf-8").alias("value"))


def _rounded(result):
    return result.select(F.round("beta", 6).alias("beta"), F.round("alpha", 6).alias("alpha"))


def stream_regression(spark, folder):
    return _rounded(line.run_available(line.running_line(line.points(_messages(spark, folder)))))


def stream_regression_sums(spark, folder):
    points = line.points(_messages(spark, folder))
    return _rounded(line.run_available(line.running_line(points, by_sums=True)))


QUERIES = {
    "stream_regression": stream_regression,
    "stream_regression_sums": stream_regression_sums,
}

_LINE = """
SELECT round(regr_slope(value, user_id), 6) AS beta, round(regr_intercept(value, user_id), 6) AS alpha
FROM events
"""

ORACLES = {"stream_regression": _LINE, "stream_regression_sums": _LINE}
