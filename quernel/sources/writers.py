"""Writers. All are single-pass; none gathers rows on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.sources import batches


def save_lines(lines: DataFrame, path: str, column: str = "line", single_file: bool = False):
    """Text output. ``single_file`` is for small reports only."""
    out = lines.select(F.col(column).cast("string").alias("value"))
    (out.coalesce(1) if single_file else out).write.text(path)


def save_tabbed(df: DataFrame, path: str):
    """``key TAB value`` text."""
    df.write.csv(path, sep="\t", quote="")


def save_json(df: DataFrame, path: str):
    """Gzipped JSON lines, replacing what is there."""
    df.write.json(path, compression="gzip", mode="overwrite")


def save_csv(df: DataFrame, path: str):
    """CSV without header, replacing what is there."""
    df.write.csv(path, mode="overwrite")


def save_routed(df: DataFrame, route: Column, path: str, fmt: str = "json"):
    """One pass over ``df``; each row goes to the subfolder ``route=<value>``."""
    df.withColumn("route", route).write.partitionBy("route").format(fmt).save(path)


def save_partitioned(df: DataFrame, columns: list[str], path: str, fmt: str = "parquet", **options):
    """Partitioned output with few files per folder.

    The rebalance hint sends rows of one folder together, and lets the
    adaptive planner split a folder that holds much of the data.
    """
    df.hint("rebalance", *columns).write.partitionBy(*columns).format(fmt).options(**options).save(path)


def save_table(df: DataFrame, fmt: str = "parquet", mode: str = "overwrite", path=None, **options):
    """Table output through any connector; ``overwrite`` empties it first.

    Connector options such as a batch size for inserts are passed on; ``quernel_batches``
    inserts in batches of ``batch`` rows.
    """
    if fmt == batches.FORMAT:
        size = int(options.get("batch", batches.BATCH_ROWS))
        return batches.save_batches(df, path, size, "append" if mode == "append" else "overwrite")
    writer = df.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()
