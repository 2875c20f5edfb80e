"""Tokens, fixed fields and formatted lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values, as the inside of a regex character class: white space as
# Unicode has it, white space in ASCII, and ASCII punctuation.
UNICODE_SPACE = (
    r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
ASCII_SPACE = r"\t\n\x0B\f\r "
PUNCTUATION = r"!-/:-@\[-`{-~"


def explode_words(
    df: DataFrame,
    column: str,
    punctuation: bool = False,
    lower: bool = False,
    space: str = UNICODE_SPACE,
    out: str = "word",
) -> DataFrame:
    """One row per token; separators are white space, and punctuation if asked for.

    Empty tokens are removed after the explode, where the filter stays inside
    generated code; a lambda over the array would not.
    """
    breaks = f"[{PUNCTUATION if punctuation else ''}{space}]+"
    words = df.select(F.explode(F.split(column, breaks)).alias(out)).where(F.col(out) != "")
    return words.withColumn(out, F.lower(out)) if lower else words


def fields(column: str, separator: str, names: list[str]) -> list[Column]:
    """Positional fields of a delimited string; missing ones are null."""
    parts = F.split(column, separator)
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)]


def key_value_line(key: str, value: str) -> Column:
    """``key value``"""
    return F.format_string("%s %s", F.col(key), F.col(value))


def keyed_pair_line(key: str, first: str, second: str) -> Column:
    """``key <tab> (first, second)``"""
    return F.format_string("%s \t (%s, %s)", F.col(key), F.col(first), F.col(second))
