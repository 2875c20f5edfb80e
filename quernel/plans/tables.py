"""The given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernel.sources import load_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_table(spark, name, folder=folder)
