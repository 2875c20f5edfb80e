"""Jobs on observations, logs, graphs, order tables and message streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel import sources
from quernel.functions.weblog import load_records, parse_log
from quernel.operators import denorm, graph, routing, series, stats, versions
from quernel.session import even_out
from quernel.streaming import ledger as books
from quernel.streaming import line


def weather_etl(spark: SparkSession, inputs: str, output: str):
    """Valid Canadian daily maxima in degrees, as gzipped JSON."""
    sources.save_json(routing.valid_observations(sources.observations(spark, inputs)), output)


def temperature_ranges(spark: SparkSession, inputs: str, output: str, sql: bool = False):
    """Stations with the largest temperature range of each day, as CSV."""
    obs = sources.observations(spark, inputs)
    ranges = series.largest_range_sql(spark, obs) if sql else series.largest_range(obs)
    sources.save_csv(ranges.orderBy("date", "station").select("date", "station", "range"), output)


def correlate_logs(spark: SparkSession, inputs: str) -> DataFrame:
    """One row r, r2: requests against bytes per host, from log files."""
    records = parse_log(sources.text_lines(spark, inputs))
    return stats.pearson(stats.points_by(records, "host", "bytes"))


def correlate_table(spark: SparkSession, name: str, fmt="parquet", folder=None, **options) -> DataFrame:
    """The same from a loaded log table."""
    records = sources.load_table(spark, name, fmt, folder, **options)
    return stats.pearson(stats.points_by(records, "host", "bytes"))


def load_logs(
    spark: SparkSession,
    inputs: str,
    path: str | None = None,
    fmt: str = "parquet",
    partitions: int | None = None,
    kind: str = "uuid",
    **options,
):
    """Valid log lines into a table that is emptied first."""
    lines = even_out(sources.text_lines(spark, inputs), partitions)
    sources.save_table(load_records(lines, kind=kind), fmt, path=path, **options)


def shortest_path(
    spark: SparkSession,
    inputs: str,
    output: str,
    start: int,
    target: int,
    debug: bool = False,
    max_hops: int | None = graph.MAX_HOPS,
):
    """One shortest path, a node per line, under ``output/path``; without ``max_hops`` of any length."""
    adjacency = sources.adjacency_lines(spark, inputs)
    edges = graph.edges(adjacency).select(
        F.trim("source").try_cast("bigint").alias("source"), F.col("dest").try_cast("bigint").alias("dest")
    )
    found = graph.search(edges, start, target, max_hops, debug_path=output if debug else None)
    lines = graph.path_lines(found, start, target)
    sources.save_lines(lines, f"{output}/path", single_file=True)


def _order_tables(spark, fmt, folder, options):
    return [
        sources.load_table(spark, name, fmt, folder, **options) for name in ("orders", "lineitem", "part")
    ]


def order_report(
    spark: SparkSession, output: str, keys: Iterable, fmt="parquet", folder=None, **options
):
    """Report lines of some orders from the three base tables."""
    orders, lineitem, part = _order_tables(spark, fmt, folder, options)
    lines = denorm.lines_of(lineitem, keys)
    report = denorm.order_report_joined(orders, lines, part, keys)
    sources.save_lines(report.orderBy("orderkey"), output, single_file=True)
    return report


def denormalize(
    spark: SparkSession, path: str | None = None, fmt="parquet", folder=None, out_options=None, **options
):
    """The wide order table, replacing what is there."""
    wide = denorm.denormalize(*_order_tables(spark, fmt, folder, options))
    sources.save_table(wide, fmt, path=path, **(out_options or {}))


def order_lookup(
    spark: SparkSession, output: str, keys: Iterable, fmt="parquet", folder=None, name="orders_parts", **options
):
    """Report lines of some orders from the wide table."""
    wide = sources.load_table(spark, name, fmt, folder, **options)
    report = denorm.order_report(wide, keys)
    sources.save_lines(report.orderBy("orderkey"), output, single_file=True)


#: Buckets of a wide table that is kept up in place.
BUCKETS = 64


def wide_create(
    spark: SparkSession, path: str, fmt="parquet", folder=None, buckets: int = BUCKETS, **options
) -> int:
    """The wide order table in key buckets, as a new version."""
    table = versions.BucketedTable(spark, path, "orderkey", buckets)
    return versions.create(table, *_order_tables(spark, fmt, folder, options))


def wide_refresh(
    spark: SparkSession, path: str, parts: Iterable, fmt="parquet", folder=None, buckets: int = BUCKETS, **options
) -> int:
    """A new version of it after some parts (keys) were added, renamed or removed in the base tables."""
    orders, lineitem, part = _order_tables(spark, fmt, folder, options)
    kind = lineitem.schema["partkey"].dataType.simpleString()
    keys = spark.createDataFrame([(str(key),) for key in parts], "key string")
    changed = keys.select(F.col("key").cast(kind).alias("partkey"))
    table = versions.BucketedTable(spark, path, "orderkey", buckets)
    return versions.refresh(table, orders, lineitem, part, changed)


def wide_lookup(spark: SparkSession, path: str, output: str, keys: Iterable, buckets: int = BUCKETS):
    """Report lines of some orders, from the buckets that hold them."""
    found = versions.BucketedTable(spark, path, "orderkey", buckets).look_up(list(keys))
    sources.save_lines(denorm.order_report(found).orderBy("orderkey"), output, single_file=True)


def stream_line(
    spark: SparkSession,
    fmt: str,
    seconds: int = 600,
    sink: str = "console",
    path=None,
    schema=None,
    ledger: str | None = None,
    checkpoint: str | None = None,
    once: bool = False,
    every: str | None = None,
    **options,
) -> DataFrame | None:
    """Running slope and intercept of a message stream, for at most ``seconds``.

    ``once`` takes what is there and ends; ``every`` is the time between batches. With ``ledger``
    and ``checkpoint`` the job goes on where it stopped, and the line of all messages so far is returned.
    """
    trigger = {"availableNow": True} if once else {"processingTime": every} if every else {}
    points = line.points(line.open_stream(spark, fmt, path, schema, **options))
    if ledger:
        if not checkpoint:
            raise ValueError("a ledger needs a checkpoint")
        query = books.start(points, ledger, checkpoint, **trigger)
    else:
        query = line.start(line.running_line(points), sink, checkpoint=checkpoint, **trigger)
    query.awaitTermination(seconds)
    query.stop()
    return books.line_so_far(spark, ledger) if ledger else None
