"""Keyed and global aggregates. Each combines rows before its one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """Mean per group; null values do not count, a null key is a group."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def max_by_group(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "max", floor=None
) -> DataFrame:
    """Largest value per group; with ``floor``, never less than that."""
    top = F.max(value)
    if floor is not None:
        top = F.greatest(top, F.lit(floor))
    return df.groupBy(*keys).agg(top.alias(out))


def partition_sums(df: DataFrame, value: str) -> DataFrame:
    """``partition, total, rows``: one row per partition that has rows, combined before the shuffle."""
    each = df.select(F.spark_partition_id().alias("partition"), F.col(value).cast("double").alias("value"))
    return each.groupBy("partition").agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"), F.count(F.lit(1)).alias("rows")
    )


def sum_partials(df: DataFrame, value: str) -> DataFrame:
    """Total and row count over the partial rows of all partitions."""
    return partition_sums(df, value).agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))


def sorted_partitions(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """``partitions`` parts by hash of the keys, each sorted by them.

    For one row per key, as after an aggregate.
    """
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``.

    Both sides are made distinct before they meet, so a row with very many
    copies crosses the network once per task.
    """
    return left.distinct().subtract(right.distinct())
