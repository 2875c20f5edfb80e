"""Web server log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.functions.text import UNICODE_SPACE

# Fixed format: host, time without zone, request path, bytes. A line in any
# other shape is not a log record.
_TOKEN = f"[^{UNICODE_SPACE}]+"
LOG_LINE = (
    rf'^({_TOKEN}) - - \[({_TOKEN}) [+-]\d+\] "[A-Z]+ ({_TOKEN}) HTTP/\d\.\d" \d+ (\d+)\z'
)
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss"


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``host, datetime, path, bytes`` of the lines that match in full.

    The pattern runs once per line: a match is rewritten to its four fields,
    none of which can hold a space, and then split. A match never equals its
    rewritten form, so an unchanged line is one that did not match. The check
    sits inside the explode because the planner would copy the pattern into a
    filter below.
    """
    rewritten = F.array(F.regexp_replace(column, LOG_LINE, "$1 $2 $3 $4"))
    matches = F.filter(rewritten, lambda fields: fields != F.col(column))
    parts = lines.select(F.explode(matches).alias("_m")).select(F.split("_m", " ").alias("_f"))
    return parts.select(
        F.get("_f", F.lit(0)).alias("host"),
        F.try_to_timestamp(F.get("_f", F.lit(1)), F.lit(LOG_TIME)).alias("datetime"),
        F.get("_f", F.lit(2)).alias("path"),
        F.get("_f", F.lit(3)).try_cast("bigint").alias("bytes"),
    )


def with_row_id(rows: DataFrame, out: str = "id", kind: str = "uuid") -> DataFrame:
    """Add a text key: random (``uuid``), or from the row's own values (``hash``).

    Equal rows share a ``hash`` key, so a repeated load replaces instead of
    adding.
    """
    if kind == "uuid":
        return rows.withColumn(out, F.expr("uuid()"))
    if kind == "hash":
        return rows.withColumn(out, F.sha2(F.to_json(F.struct(*rows.columns)), 256))
    raise ValueError(f"unknown kind {kind!r}")


def load_records(lines: DataFrame, column: str = "value", kind: str = "uuid") -> DataFrame:
    """Valid log lines as table rows ``host, id, datetime, path, bytes``."""
    rows = parse_log(lines, column).where(F.col("datetime").isNotNull())
    return with_row_id(rows, "id", kind).select("host", "id", "datetime", "path", "bytes")
