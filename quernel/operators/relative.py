"""Each row's value relative to the mean of its group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.operators.joins import BROADCAST_BYTES, HOT_ROWS, hot_keys, lookup_join
from quernel.session import materialize


def group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    """Written table of groups: mean and row count."""
    means = df.groupBy(group).agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("_rows"))
    return materialize(means, "means")


def relative_score(
    df: DataFrame,
    group: str,
    value: str,
    out: str = "relative",
    strategy: str = "auto",
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of groups with a positive mean, plus value / mean.

    ``auto`` or ``broadcast``: the means go to all executors if their measured
    size allows, else as ``shuffle``. ``shuffle``: rows are shuffled by group,
    but those of very large groups meet a broadcast of just their means.
    ``window``: as ``shuffle``, with the mean of all other groups taken by a
    window over them.
    """
    means = group_means(df, group, value)
    positive = means.where(F.col("_mean") > 0)

    def hot():
        return materialize(hot_keys(means, [group], "_rows", hot_rows), "hot-groups")

    if strategy == "window":
        scored = _by_window(df, positive, hot(), group, value)
    else:
        lookup = positive.drop("_rows")
        scored = lookup_join(df, lookup, [group], hot, strategy, limit)
    return scored.select(*df.columns, (F.col(value) / F.col("_mean")).alias(out))


def _by_window(df, positive, hot, group, value):
    def cold_rows(rows):
        mean = F.avg(value).over(Window.partitionBy(group))
        return rows.where(F.col(group).isNotNull()).withColumn("_mean", mean).where(F.col("_mean") > 0)

    if hot.isEmpty():
        return cold_rows(df)
    hot = F.broadcast(hot)
    near = df.join(F.broadcast(positive.drop("_rows").join(hot, group, "left_semi")), group)
    far = cold_rows(df.join(hot, group, "left_anti"))
    return near.unionByName(far.select(*near.columns))


def by_score(scores: DataFrame, score: str, *ties: str) -> DataFrame:
    """Highest score first, then by ``ties``.

    Rows equal in all of these are told apart by a row number, so that very
    many of them do not fall into one range of the sort. The table is written
    first: the sort samples its input before it reads it, and would compute
    the scores twice; and row numbers over files stay the same when a lost
    task runs again.
    """
    written = materialize(scores, "scores").withColumn("_row", F.monotonically_increasing_id())
    return written.orderBy(F.desc(score), *ties, "_row").drop("_row")
