"""Largest row per group, with a stated rule for ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.operators.joins import BROADCAST_BYTES, HOT_ROWS, hot_keys, lookup_join
from quernel.session import materialize


def _matching(df: DataFrame, group: str, value: str, tops: DataFrame, strategy: str, hot_rows: int, limit: int):
    """Rows of ``df`` at their group's top; ``tops`` also counts rows as ``_rows``."""
    tops = materialize(tops, "tops")

    def hot():
        return materialize(hot_keys(tops, [group, value], "_rows", hot_rows), "hot-tops")

    lookup = tops.select(group, value)
    return lookup_join(df, lookup, [group, value], hot, strategy, limit).select(*df.columns)


def top_rows(
    df: DataFrame,
    group: str,
    value: str,
    strategy: str = "auto",
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows that hold their group's largest value; rows of a null group drop out.

    The maxima, one small row per group, are written first; if they are small
    enough to broadcast, the rows are filtered where they are read. Otherwise
    the join is on (group, value), with very large groups kept off the shuffle.
    """
    tops = df.groupBy(group).agg(F.max(value).alias(value), F.count(F.lit(1)).alias("_rows"))
    return _matching(df, group, value, tops.where(F.col(value).isNotNull()), strategy, hot_rows, limit)


def top_rows_window(
    df: DataFrame, group: str, value: str, hot_rows: int = HOT_ROWS, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The same rows, with the maxima found by a ranking window.

    The window sees each (group, value) once, and the planner limits it to
    rank 1 in every task before the shuffle, so no task receives a group.
    """
    by_value = Window.partitionBy(group).orderBy(F.desc(value))
    tops = (
        df.where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_rank", F.rank().over(by_value))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
    return _matching(df, group, value, tops, "auto", hot_rows, limit)


def top_one(
    df: DataFrame, group: str, value: str, item: str, floor: int | None = None
) -> DataFrame:
    """One row per group: its largest value and, of the tied items, the smallest.

    One aggregate over one scan; rows of a group combine before the shuffle. A
    group without values drops out. With ``floor`` a group that never exceeds
    it gives an empty item and the floor itself.
    """
    # Of equal values the least item, null last, by one order: value down, item up.
    place = F.struct((-F.col(value)).alias("_down"), F.col(item).isNull().alias("_none"), F.col(item))
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    best = known.groupBy(group).agg(F.min(place).alias("_best"), F.max(value).alias(value))
    one = best.select(group, F.col("_best")[item].alias(item), value)
    if floor is None:
        return one
    below = F.col(value) <= floor
    return one.select(
        group,
        F.when(below, F.lit("")).otherwise(F.col(item)).alias(item),
        F.greatest(value, F.lit(floor)).alias(value),
    )


def top_joined(df: DataFrame, group: str, value: str, item: str) -> DataFrame:
    """One row per group with its tied items in one string, ``a, b``.

    Titles are made distinct first; only the distinct ties of a group meet, in
    one row, as asked for: a group with more of them than a row holds fails.
    """
    ties = top_rows(df.select(group, value, item), group, value).distinct()
    names = F.array_join(F.array_sort(F.collect_list(item)), ", ")
    return ties.groupBy(group, value).agg(names.alias(item)).select(group, item, value)


def article_rows(
    df: DataFrame, language: str = "language", title: str = "title", fold: bool = True
) -> DataFrame:
    """English article pages: no main page, no special pages."""
    lang = F.lower(language) if fold else F.col(language)
    return df.where(
        (lang == "en") & (F.col(title) != "Main_Page") & ~F.col(title).startswith("Special:")
    )
