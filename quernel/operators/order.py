"""Proof that rows are in order, and global row numbers, without gathering rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.session import materialize


def placed(rows: DataFrame) -> DataFrame:
    """``rows``, written, with their partition and their place in it as they came."""
    at = F.monotonically_increasing_id()
    written = materialize(rows.withColumn("_at", at), "placed")
    return written.withColumn("_part", F.shiftright("_at", 33))


def certificate(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``part, rows, first, last, inside, after``: a row per partition of ``placed`` rows.

    ``first`` and ``last`` are the key of its first and last row, ``inside`` says that its rows are in
    ascending order (null first), ``after`` that it begins no lower than the one before it ended. All rows are in
    order if both hold everywhere. The windows see one partition's rows, and the few rows per partition.
    """
    key = F.struct(*keys)
    before = F.lag(key).over(Window.partitionBy("_part").orderBy("_at"))
    steps = rows.select("_part", "_at", key.alias("key"), (before.isNull() | (before <= key)).alias("step"))
    parts = steps.groupBy("_part").agg(
        F.count("*").alias("rows"),
        F.min_by("key", "_at").alias("first"),
        F.max_by("key", "_at").alias("last"),
        F.min("step").alias("inside"),
    )
    last = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("_part"))
    return parts.select(
        F.col("_part").alias("part"), "rows", "first", "last", "inside", (last.isNull() | (last <= F.col("first"))).alias("after")
    )


def row_numbers(rows: DataFrame, out: str = "row_number") -> DataFrame:
    """``placed`` rows with their number from 1: the place in the partition and the rows of those before it."""
    counts = rows.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    # One row per partition.
    numbered = rows.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop(
        "_at", "_part", "_first", "_before"
    )
