"""Part names per order: report lines, the wide table, and its upkeep."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.operators.joins import hot_keys, lookup_join
from quernel.session import materialize

ORDER_LINE = "Order #%d $%.2f: %s"


def part_names(
    lineitem: DataFrame,
    part: DataFrame,
    order_key: str = "orderkey",
    part_key: str = "partkey",
    name: str = "name",
    out: str = "part_names",
) -> DataFrame:
    """One row per order with the sorted set of its part names.

    (order, part) pairs are made distinct first, over both keys: an order with
    very many lines is spread over the tasks, and only its distinct parts meet.
    """
    pairs = lineitem.select(order_key, part_key).distinct()
    named = pairs.join(part.select(part_key, name), part_key)
    return named.groupBy(order_key).agg(F.array_sort(F.collect_set(name)).alias(out))


def with_keys(df: DataFrame, column: str, keys: Iterable | None) -> DataFrame:
    """Keep rows whose ``column`` is in ``keys``; all rows if ``keys`` is None.

    Keys, often text from a command line, are cast to the column's type here,
    so that the scan receives a typed IN list.
    """
    if keys is None:
        return df
    kind = df.schema[column].dataType
    return df.where(F.col(column).isin([F.lit(key).cast(kind) for key in keys]))


def denormalize(
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    order_key: str = "orderkey",
    part_key: str = "partkey",
    name: str = "name",
    out: str = "part_names",
) -> DataFrame:
    """All order columns plus the set of part names; orders without lines drop out."""
    names = part_names(lineitem, part, order_key, part_key, name, out)
    return orders.join(names, order_key).select(*orders.columns, out)


def order_report(
    wide: DataFrame,
    keys: Iterable | None = None,
    order_key: str = "orderkey",
    price: str = "totalprice",
    names: str = "part_names",
) -> DataFrame:
    """Report lines ``(order_key, line)`` from the wide table."""
    line = F.format_string(
        ORDER_LINE,
        F.col(order_key).cast("bigint"),
        F.col(price).cast("double"),
        F.array_join(F.array_sort(names), ", "),
    )
    return with_keys(wide, order_key, keys).select(order_key, line.alias("line"))


def order_report_joined(
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    keys: Iterable | None = None,
    order_key: str = "orderkey",
    part_key: str = "partkey",
    name: str = "name",
    price: str = "totalprice",
) -> DataFrame:
    """The same report from the three base tables; keys are filtered at both scans."""
    wide = denormalize(
        with_keys(orders.select(order_key, price), order_key, keys),
        with_keys(lineitem, order_key, keys),
        part,
        order_key,
        part_key,
        name,
    )
    return order_report(wide, None, order_key, price)


def lines_of(
    lineitem: DataFrame, keys: Iterable, order_key: str = "orderkey", part_key: str = "partkey"
) -> DataFrame:
    """The (order, part) pairs of some orders, written.

    Their true size is known then, so a few orders are broadcast to the part
    scan; without it the planner, which sees only the size of all lines, would
    shuffle every part.
    """
    pairs = with_keys(lineitem.select(order_key, part_key), order_key, keys).distinct()
    return materialize(pairs, "order-lines")


def latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Last row written per key, as a table with a primary key keeps it.

    Of rows with the same version, the largest by their columns in order. An
    aggregate, not a window: rows of a much-written key combine before the
    shuffle.
    """
    whole = F.struct(*df.columns)
    last = F.max(F.struct(F.col(version).alias("_version"), whole.alias("_row")))
    return df.groupBy(*keys).agg(last.alias("_last")).select("_last._row.*")


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with rows replaced or added by ``updates`` (one row per key)."""
    kept = base.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates)


def orders_using(
    lineitem: DataFrame, changed: DataFrame, order_key: str = "orderkey", part_key: str = "partkey"
) -> DataFrame:
    """Keys of the orders that have a line with one of the ``changed`` parts."""
    lines = lineitem.select(order_key, part_key)
    return lines.join(changed.select(part_key), part_key, "left_semi").select(order_key).distinct()


def _large_orders(lineitem: DataFrame, order_key: str):
    """Keys of the orders with too many lines for a task, counted only if the join asks for them."""

    def hot():
        counts = lineitem.groupBy(order_key).agg(F.count(F.lit(1)).alias("_n"))
        return materialize(hot_keys(counts, [order_key], "_n"), "large-orders")

    return hot


def rebuild(
    wide: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    touched: DataFrame,
    order_key: str = "orderkey",
    part_key: str = "partkey",
    name: str = "name",
    out: str = "part_names",
) -> DataFrame:
    """The wide table with the ``touched`` orders (distinct keys) made again.

    For new, changed and deleted orders. The base tables are those after the
    change; an order that is gone, or has no parts left, drops out.

    Lines of an order too large for a task meet a broadcast of such orders and
    are not shuffled by order.
    """
    touched = materialize(touched.select(order_key), "touched-orders")
    again = denormalize(
        lookup_join(orders, touched, [order_key]).select(*orders.columns),
        lookup_join(lineitem, touched, [order_key], _large_orders(lineitem, order_key)).select(*lineitem.columns),
        part,
        order_key,
        part_key,
        name,
        out,
    )
    return wide.join(touched, order_key, "left_anti").unionByName(again)


def refresh(
    wide: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    changed: DataFrame,
    order_key: str = "orderkey",
    part_key: str = "partkey",
    name: str = "name",
    out: str = "part_names",
) -> DataFrame:
    """The wide table after parts in ``changed`` were inserted, renamed or deleted.

    Only orders that use a changed part are rebuilt. ``part`` is the table
    after the change.
    """
    touched = orders_using(lineitem, changed, order_key, part_key)
    return rebuild(wide, orders, lineitem, part, touched, order_key, part_key, name, out)
