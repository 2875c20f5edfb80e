"""Readers: files with explicit schemas, tables behind any connector, literals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.functions.text import UNICODE_SPACE, fields
from quernel.sources import schemas


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files or folders as ``value``; gzip is read by extension."""
    return spark.read.text(path)


def load_table(
    spark: SparkSession, name: str, fmt: str = "parquet", folder: str | None = None, **options
) -> DataFrame:
    """A table by name.

    ``folder`` holds one file or directory per table; without it the name goes
    to the connector ``fmt`` as its ``table`` option, with ``options`` beside.
    """
    reader = spark.read.format(fmt).options(**options)
    if folder is None:
        return reader.option("table", name).load()
    return reader.load(f"{folder}/{name}" + (f".{fmt}" if fmt == "parquet" else ""))


def literal_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A few rows given in the program, as a table."""
    return spark.createDataFrame(rows, schema)


def observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.OBSERVATION)


def comments(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; a field absent from a row is null."""
    return spark.read.json(path, schema=schemas.COMMENT)


def tmax_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.TMAX)


def colour_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.COLOUR)


def adjacency_lines(spark: SparkSession, path: str) -> DataFrame:
    """``node: n1 n2 ...`` lines as (source, dest), dest still one string."""
    return spark.read.csv(path, sep=":", schema=schemas.ADJACENCY)


def file_label(pattern: str) -> Column:
    """First group of ``pattern`` in the path of the file a row came from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


PAGE_FILE = r"pagecounts-(\d{8}-\d{2})"


@F.pandas_udf(T.StringType())
def hour_of_path(paths: pd.Series) -> pd.Series:
    """The label as a vectorised UDF; ``file_label`` does it without leaving the engine."""
    return paths.str.extract(PAGE_FILE, expand=False)


def page_counts(spark: SparkSession, path: str, udf: bool = False) -> DataFrame:
    """Space-separated page counts with the hour taken from the file name.

    Titles hold quote characters that mean nothing, so quoting is off.
    """
    rows = spark.read.csv(path, sep=" ", quote="", schema=schemas.PAGE_COUNT)
    hour = hour_of_path(F.col("_metadata.file_path")) if udf else file_label(PAGE_FILE)
    return rows.select("*", hour.alias("hour"))


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Page counts whose first field is the hour: ``hour language title views size``."""
    names = ["hour", "language", "title", "views", "size"]
    parts = text_lines(spark, path).select(*fields("value", f"[{UNICODE_SPACE}]+", names))
    return parts.withColumns({c: F.col(c).try_cast("bigint") for c in ("views", "size")})
