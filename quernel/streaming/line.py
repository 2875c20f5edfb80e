"""Least-squares line over a stream of ``"x y"`` messages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernel.functions.text import fields
from quernel.operators.stats import fitted_line, line_of_sums, power_sums
from quernel.session import scratch_path


def open_stream(spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """A stream source by format name and options, such as a message queue or files."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def points(messages: DataFrame, value: str = "value") -> DataFrame:
    """``x, y`` as doubles from binary or text messages.

    A message that is not two numbers gives nulls, which no statistic counts.
    """
    text = messages.select(F.decode(F.col(value).cast("binary"), "utf-8").alias("_text"))
    x, y = fields("_text", " ", ["x", "y"])
    pair = text.select(x, y)
    return pair.select(F.col("x").try_cast("double").alias("x"), F.col("y").try_cast("double").alias("y"))


def running_line(xy: DataFrame, by_sums: bool = False) -> DataFrame:
    """``beta, alpha`` of all points since the start; the state is one row."""
    return line_of_sums(power_sums(xy)) if by_sums else fitted_line(xy)


def start(
    result: DataFrame, fmt: str = "console", name: str | None = None, checkpoint: str | None = None, **trigger
) -> StreamingQuery:
    """Start a complete-mode query; every output is the whole result so far."""
    spark = result.sparkSession
    writer = result.writeStream.outputMode("complete").format(fmt)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_available(result: DataFrame) -> DataFrame:
    """Process what the source holds now and return the last output.

    For results of a few rows: the memory sink keeps them on the driver.
    """
    name = f"line_{uuid.uuid4().hex}"
    query = start(result, "memory", name, availableNow=True)
    query.awaitTermination()
    return result.sparkSession.table(name)
