"""Filter-and-route and filter-and-scale jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def containing(df: DataFrame, column: str, part: str = "e") -> DataFrame:
    """Rows whose ``column`` contains ``part``, case-sensitive."""
    return df.where(F.col(column).contains(part))


def sign_route(column: str) -> Column:
    """``positive`` for values of zero or more, else ``negative``; null has no route."""
    return F.when(F.col(column) >= 0, F.lit("positive")).when(F.col(column) < 0, F.lit("negative"))


def split_by_sign(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The two outputs as two tables; each filter reaches the scan on its own."""
    return df.where(F.col(column) >= 0), df.where(F.col(column) < 0)


def valid_observations(
    df: DataFrame, prefix: str = "CA", kind: str = "TMAX", out: str | None = None
) -> DataFrame:
    """Unflagged observations of one kind from stations with a prefix, in whole units."""
    return df.where(
        F.col("qflag").isNull() & F.col("station").startswith(prefix) & (F.col("observation") == kind)
    ).select("station", "date", (F.col("value") / 10).alias(out or kind))
