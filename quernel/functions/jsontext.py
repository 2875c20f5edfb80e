"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by the fields of ``schema``; absent fields are null."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.from_json(column, schema).alias("_j")).select(*rest, "_j.*")


def object_line(*columns: str) -> Column:
    """Row as a JSON object."""
    return F.to_json(F.struct(*columns))


def array_line(*columns: str) -> Column:
    """Row as a JSON array of values of different types, such as ``["a",1.5]``."""
    return F.to_json(F.array(*[F.col(c).cast("variant") for c in columns]))
