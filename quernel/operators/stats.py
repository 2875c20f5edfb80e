"""Correlation and least squares, from built-ins and from plain sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def points_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """One point per key: x = rows with a key, y = sum of the value."""
    return df.groupBy(key).agg(
        F.count(key).cast("double").alias("x"), F.sum(value).cast("double").alias("y")
    )


def power_sums(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: n and the sums of x, y, x*x, y*y, x*y, all as doubles."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    both = points.where(cx.isNotNull() & cy.isNotNull())
    return both.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(cx).alias("sx"),
        F.sum(cy).alias("sy"),
        F.sum(cx * cx).alias("sxx"),
        F.sum(cy * cy).alias("syy"),
        F.sum(cx * cy).alias("sxy"),
    )


def pearson_of_sums(sums: DataFrame) -> DataFrame:
    """r and r2 from the sums; null when either series is constant."""
    spread_x = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    spread_y = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    shared = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    r = F.try_divide(shared, F.sqrt(F.greatest(spread_x, F.lit(0.0))) * F.sqrt(F.greatest(spread_y, F.lit(0.0))))
    return sums.select(r.alias("r"), (r * r).alias("r2"))


def _stable_r(x: str, y: str) -> Column:
    return F.try_divide(
        F.covar_pop(x, y),
        F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x)))
        * F.stddev_pop(F.when(F.col(x).isNotNull(), F.col(y))),
    )


def pearson(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """r and r2 from central moments.

    Plain sums of squares lose digits when values are large next to their
    spread; moments merged pairwise do not.
    """
    row = points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    r = row.agg(_stable_r("x", "y").alias("r"))
    return r.select("r", (F.col("r") * F.col("r")).alias("r2"))


def line_of_sums(sums: DataFrame) -> DataFrame:
    """Slope beta and intercept alpha from the sums; null when x is constant."""
    beta = F.try_divide(
        F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
        F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"),
    )
    alpha = F.try_divide("sy", "n") - beta * F.try_divide("sx", "n")
    return sums.select(beta.alias("beta"), alpha.alias("alpha"))


def fitted_line(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Least-squares slope beta and intercept alpha; works on a stream as well."""
    return points.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("beta"),
        F.regr_intercept(F.col(y), F.col(x)).alias("alpha"),
    )
