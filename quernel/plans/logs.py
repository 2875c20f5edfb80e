"""Web-log jobs on lines rendered from events, and labels from file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.functions.weblog import load_records, parse_log
from quernel.operators import stats
from quernel.plans.tables import table
from quernel.session import even_out, scratch_path
from quernel.sources import page_counts, save_partitioned, text_lines


def log_lines(spark, folder):
    """One log line per event; errors have no byte count and must not parse."""
    events = even_out(table(spark, folder, "events"))
    size = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(
        F.floor(F.col("value") * 10).cast("bigint").cast("string")
    )
    line = F.format_string(
        'h%s - - [%s -0400] "GET /%s/%s HTTP/1.0" 200 %s',
        F.col("user_id"),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.col("event_type"),
        F.col("event_id"),
        size,
    )
    return events.select(line.alias("value"))


def log_etl(spark, folder):
    """Lines written as gzip text, parsed back into table rows."""
    path = scratch_path(spark, "log-lines")
    log_lines(spark, folder).write.text(path, compression="gzip")
    rows = load_records(text_lines(spark, path), kind="hash")
    return rows.select(
        "host", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "path", "bytes"
    )


def _rounded(pair):
    return pair.select(F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"))


def correlate_logs(spark, folder):
    records = parse_log(log_lines(spark, folder))
    return _rounded(stats.pearson(stats.points_by(records, "host", "bytes")))


def correlate(spark, folder):
    events = table(spark, folder, "events")
    return _rounded(stats.pearson(stats.points_by(events, "user_id", "value")))


def correlate_sums(spark, folder):
    events = table(spark, folder, "events")
    sums = stats.power_sums(stats.points_by(events, "user_id", "value"))
    return _rounded(stats.pearson_of_sums(sums))


def _page_files(spark, folder):
    """Page counts in one folder per hour, named as the files are."""
    events = table(spark, folder, "events")
    counts = events.select(
        F.lit("en").alias("language"),
        F.concat("event_type", F.lit('"'), F.col("event_id")).alias("title"),
        F.floor("value").cast("bigint").alias("views"),
        F.col("user_id").alias("size"),
        F.concat(
            F.lit("pagecounts-"), F.date_format(F.date_trunc("day", "ts"), "yyyyMMdd-HHmmss")
        ).alias("file"),
    )
    path = scratch_path(spark, "page-counts")
    save_partitioned(counts, ["file"], path, fmt="csv", sep=" ", quote="")
    return f"{path}/*"


def file_hour(spark, folder):
    """The hour comes back from the path."""
    return page_counts(spark, _page_files(spark, folder)).select("hour", "title", "views", "size")


def file_hour_udf(spark, folder):
    pages = page_counts(spark, _page_files(spark, folder), udf=True)
    return pages.select("hour", "title", "views", "size")


QUERIES = {
    "log_etl": log_etl,
    "correlate_logs": correlate_logs,
    "correlate": correlate,
    "correlate_sums": correlate_sums,
    "file_hour": file_hour,
    "file_hour_udf": file_hour_udf,
}

_CORRELATE = """
SELECT round(corr(y, x), 6) AS r, round(pow(corr(y, x), 2), 6) AS r2
FROM (SELECT {key}, CAST(count(*) AS DOUBLE) AS x, CAST(sum({value}) AS DOUBLE) AS y
      FROM events {where} GROUP BY {key})
"""

ORACLES = {
    "log_etl": """
SELECT 'h' || user_id AS host, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime,
       '/' || event_type || '/' || event_id AS path, CAST(floor(value * 10) AS BIGINT) AS bytes
FROM events WHERE event_type <> 'error'
""",
    "correlate_logs": _CORRELATE.format(
        key="user_id", value="CAST(floor(value * 10) AS BIGINT)", where="WHERE event_type <> 'error'"
    ),
    "correlate": _CORRELATE.format(key="user_id", value="value", where=""),
    "correlate_sums": _CORRELATE.format(key="user_id", value="value", where=""),
    "file_hour": """
SELECT strftime(ts, '%Y%m%d-00') AS hour, event_type || '"' || event_id AS title,
       CAST(floor(value) AS BIGINT) AS views, user_id AS size
FROM events
""",
}
ORACLES["file_hour_udf"] = ORACLES["file_hour"]
