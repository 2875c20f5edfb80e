"""Joins of many rows to a table with one row per key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
# A key with more rows than this is kept off the shuffle ...
HOT_ROWS = 1_000_000
# ... and at most this many keys can be: total / HOT_KEYS is the least limit.
HOT_KEYS = 50_000


def row_bytes(df: DataFrame) -> Column:
    """Size of one row of ``df``, near enough to bound a broadcast."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            inside = F.octet_length(column)
        elif isinstance(field.dataType, T.ArrayType):
            inside = 16 * F.size(column)
            if isinstance(field.dataType.elementType, T.StringType):
                inside = inside + F.octet_length(F.array_join(column, ""))
        elif isinstance(field.dataType, (T.StructType, T.MapType)):
            inside = F.octet_length(F.to_json(F.struct(column)))
        else:
            inside = F.lit(0)
        width = width + 16 + F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in bytes, from one aggregate over it. Meant for written tables."""
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)


def hot_keys(
    groups: DataFrame, keys: Sequence[str], rows: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys of ``groups`` (one row per key, ``rows`` = its row count) too big for a task.

    The limit is at least total / HOT_KEYS, so no more than HOT_KEYS keys can
    exceed it: the result is small whatever the data.
    """
    total = groups.agg(F.sum(rows)).first()[0] or 0
    limit = max(hot_rows, total // HOT_KEYS)
    return groups.where(F.col(rows) > limit).select(*keys)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    hot: Callable[[], DataFrame] | None = None,
    strategy: str = "auto",
    limit: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key, a written table).

    ``auto`` and ``broadcast`` send the table to all executors if its measured
    size (``size``, if the caller has measured it) is within ``limit``. Otherwise, and always with ``shuffle``, ``hot`` is
    called for a written table of hot keys (a bounded list): their rows meet a
    broadcast of just those table rows, and only the other rows are shuffled.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    keys = list(keys)
    if strategy != "shuffle":
        size = measured_bytes(table) if size is None else size
        if size <= limit:
            return rows.join(F.broadcast(table), keys)
    heavy = hot() if hot else None
    if heavy is None or heavy.isEmpty():
        return rows.join(table.hint("merge"), keys)
    heavy = F.broadcast(heavy.select(*keys))
    near = rows.join(F.broadcast(table.join(heavy, keys, "left_semi")), keys)
    far = rows.join(heavy, keys, "left_anti").join(table.hint("merge"), keys)
    return near.unionByName(far)
