"""Scores of predictions from one mergeable state each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_scores(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``n, r2, rmse, mae`` from a single aggregate.

    Rows with a null on either side are not counted. r2 is null where the label is constant.
    """
    y, off = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    both = F.when(off.isNotNull(), y)
    state = predictions.agg(
        F.count(off).alias("n"),
        F.sum(off * off).alias("squares"),
        F.sum(F.abs(off)).alias("absolute"),
        F.var_pop(both).alias("variance"),
    )
    spread = F.col("n") * F.col("variance")
    return state.select(
        "n",
        F.when(spread > 0, 1 - F.col("squares") / spread).alias("r2"),
        F.sqrt(F.col("squares") / F.col("n")).alias("rmse"),
        (F.col("absolute") / F.col("n")).alias("mae"),
    )


def confusion(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n``: counts of the pairs, combined before the shuffle."""
    pairs = predictions.select(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    return pairs.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def class_scores(counts: DataFrame) -> DataFrame:
    """Per class of a confusion table: support, precision, recall, f1, and the accuracy of all.

    A class that is only predicted has support 0. Where a ratio has no rows to count, it is 0.
    """
    side = [
        F.struct(F.col("label").alias("word"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("taken")),
        F.struct(F.col("prediction").alias("word"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("taken")),
    ]
    hit = F.when(F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0)
    sides = counts.select(F.explode(F.array(*side)).alias("s"), hit.alias("hit"))
    sums = sides.groupBy(F.col("s.word").alias("word")).agg(
        F.sum("s.support").alias("support"),
        F.sum("s.taken").alias("taken"),
        # Each pair came twice.
        (F.sum("hit") / 2).alias("hits"),
    )
    total = counts.agg((F.sum(hit) / F.sum("n")).alias("accuracy"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    scored = sums.withColumn("precision", ratio("hits", "taken")).withColumn("recall", ratio("hits", "support"))
    parts = F.col("precision") + F.col("recall")
    f1 = F.when(parts > 0, 2 * F.col("precision") * F.col("recall") / parts).otherwise(0.0)
    return scored.select("word", "support", "precision", "recall", f1.alias("f1")).join(F.broadcast(total))


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Share of rows whose prediction is the label; nan without rows."""
    hit = F.col(label).eqNullSafe(F.col(prediction)).cast("double")
    found = predictions.agg(F.avg(hit)).first()[0]
    return float("nan") if found is None else found
