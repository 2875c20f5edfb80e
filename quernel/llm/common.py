"""Text helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.sources import load_table

#: Fixed values of the contracts: white space, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, "documents", folder=folder)


def whole(text: str | Column = "text") -> Column:
    """The text as it is; a null text is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is.

    ``lower`` does this by itself, and faster, where every character is one byte.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Array of the maximal runs without white space; empty for a blank text."""
    inner = strip(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def n_words(text: Column) -> Column:
    """Number of the maximal runs without white space."""
    inner = strip(text)
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACES))).cast("bigint")


def text_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def text_hash(text: str | Column = "text") -> Column:
    """With the id it names a row, also where ids are null or repeated with other texts."""
    return F.xxhash64(whole(text))


#: Rows up to which a list of rows is broadcast (16 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names with as many underscores before them as it takes for ``df`` to have none of them, in any case."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any(mark + name in taken for name in names):
        mark += "_"
    return [mark + name for name in names]


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows with an (id, text hash) of ``gone``, which has columns doc_id and text_hash."""
    gone_id, gone_hash = unused(docs, "gone_id", "gone_hash")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash))
    small = gone.count() <= BROADCAST_ROWS
    same = docs["doc_id"].eqNullSafe(F.col(gone_id)) & (text_hash(docs["text"]) == F.col(gone_hash))
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")
