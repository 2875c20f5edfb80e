"""Whole jobs from files to files, on files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel import sources
from quernel.jobs import tables, text
from quernel.operators import graph
from quernel.plans.logs import log_lines
from quernel.plans.paths import adjacency
from quernel.plans.tables import table
from quernel.session import scratch_path
from quernel.sources import batches


def _pages(spark, folder):
    """Page counts with pages that are no articles, and languages in both cases."""
    number = F.col("event_id")
    title = (
        F.when(number % 10 == 0, "Main_Page")
        .when(number % 10 == 1, F.concat(F.lit("Special:"), "event_type"))
        .otherwise(F.concat_ws("_", "event_type", F.col("user_id") % 50))
    )
    language = F.when(number % 4 == 0, "EN").when(number % 4 == 1, "fr").otherwise("en")
    day = F.date_format(F.date_trunc("day", "ts"), "yyyyMMdd-HH")
    views = F.floor("value").cast("bigint")
    return table(spark, folder, "events").select(
        language.alias("language"), title.alias("title"), views.alias("views"), F.col("user_id").alias("size"), day.alias("day")
    )


def page_file_tops(spark, folder):
    """The most viewed articles of every file, ties included, written as JSON."""
    files, out = scratch_path(spark, "page-files"), scratch_path(spark, "page-tops")
    named = F.concat(F.lit("pagecounts-"), "day", F.lit("0000")).alias("file")
    pages = _pages(spark, folder).select("language", "title", "views", "size", named)
    sources.save_partitioned(pages, ["file"], files, fmt="csv", sep=" ", quote="")
    text.page_tops_by_file(spark, f"{files}/*", out, fold=True)
    return spark.read.schema("hour string, title string, views bigint").json(out)


def page_maxima_tabbed(spark, folder):
    """The largest count of every hour, written as tabbed text."""
    files, out = scratch_path(spark, "page-lines"), scratch_path(spark, "page-maxima")
    line = F.concat_ws(" ", "day", "language", "title", "views", "size")
    _pages(spark, folder).select(line.alias("value")).write.text(files)
    text.page_maxima(spark, files, out)
    return spark.read.csv(out, sep="\t", quote="", schema="hour string, views bigint")


def adjacency_files(spark, folder):
    """Edges from ``node: neighbours`` text."""
    files = scratch_path(spark, "adjacency")
    adjacency(spark, folder).select(F.concat_ws(":", "source", "dest").alias("value")).write.text(files)
    return graph.edges(sources.adjacency_lines(spark, files))


def _observation_files(spark, folder):
    """Clicks as highs and views as lows of two countries' stations; very high values are flagged."""
    kind = F.when(F.col("event_type") == "click", "TMAX").when(F.col("event_type") == "view", "TMIN").otherwise("PRCP")
    none = F.lit(None).cast("string")
    rows = table(spark, folder, "events").select(
        F.concat(F.when(F.col("user_id") % 3 == 0, "US").otherwise("CA"), "user_id").alias("station"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        kind.alias("observation"),
        F.floor("value").cast("int").alias("value"),
        none.alias("mflag"),
        F.when(F.col("value") > 300, "X").alias("qflag"),
        F.lit("C").alias("sflag"),
        none.alias("obstime"),
    )
    files = scratch_path(spark, "observations")
    sources.save_csv(rows, files)
    return files


def weather_etl_files(spark, folder):
    """CSV in, gzipped JSON out."""
    out = scratch_path(spark, "weather")
    tables.weather_etl(spark, _observation_files(spark, folder), out)
    return spark.read.json(out, schema="station string, date string, TMAX double")


def temperature_range_files(spark, folder):
    """CSV in, CSV out."""
    out = scratch_path(spark, "ranges")
    tables.temperature_ranges(spark, _observation_files(spark, folder), out)
    return spark.read.csv(out, schema="date string, station string, range double")


def _comment_files(spark, folder):
    """Events as comments in gzipped JSON; some have no score."""
    rows = table(spark, folder, "events").select(
        F.col("event_type").alias("subreddit"),
        F.concat(F.lit("u"), "user_id").alias("author"),
        F.when(F.col("event_id") % 7 > 0, F.floor("value").cast("bigint") - 48).alias("score"),
    )
    files = scratch_path(spark, "comments")
    sources.save_json(rows, files)
    return files


def comment_mean_files(spark, folder):
    """JSON in, CSV out."""
    out = scratch_path(spark, "comment-means")
    text.comment_means(spark, _comment_files(spark, folder), out)
    means = spark.read.csv(out, schema="subreddit string, mean double")
    return means.select("subreddit", F.round("mean", 6).alias("mean"))


def comment_route_files(spark, folder):
    """JSON in, two folders of JSON arrays out."""
    out = scratch_path(spark, "comment-routes")
    text.comment_routes(spark, _comment_files(spark, folder), out, folders=True)
    sides = [
        sources.text_lines(spark, f"{out}/{side}").select(F.lit(side).alias("side"), F.col("value").alias("line"))
        for side in ("positive", "negative")
    ]
    return sides[0].unionByName(sides[1])


def log_store(spark, folder):
    """Log lines loaded twice into a table that is emptied first; keys come from the rows."""
    files, store = scratch_path(spark, "log-files"), scratch_path(spark, "log-store")
    log_lines(spark, folder).write.text(files, compression="gzip")
    for _ in range(2):
        tables.load_logs(spark, files, f"{store}/logs.parquet", kind="hash")
    rows = sources.load_table(spark, "logs", folder=store)
    return rows.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))


def batched_store(spark, folder):
    """Parts inserted in batches of 250 rows and read back; no batch is larger, and only a task's last is smaller."""
    store = scratch_path(spark, "batches")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand").repartition(3, "p_partkey")
    sources.save_table(part, batches.FORMAT, path=store)
    sizes = [rows for _, rows in batches.listed(store)]
    fit = max(sizes) <= batches.BATCH_ROWS and sum(n < batches.BATCH_ROWS for n in sizes) <= 3
    rows = batches.load_batches(spark, store, "p_partkey bigint, p_name string, p_brand string")
    return rows.withColumn("sizes_fit", F.lit(fit))


QUERIES = {
    "page_file_tops": page_file_tops,
    "page_maxima_tabbed": page_maxima_tabbed,
    "adjacency_files": adjacency_files,
    "weather_etl_files": weather_etl_files,
    "temperature_range_files": temperature_range_files,
    "comment_mean_files": comment_mean_files,
    "comment_route_files": comment_route_files,
    "log_store": log_store,
    "batched_store": batched_store,
}

_PAGES = """
pages AS (
  SELECT CASE event_id % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'fr' ELSE 'en' END AS language,
         CASE event_id % 10 WHEN 0 THEN 'Main_Page' WHEN 1 THEN 'Special:' || event_type
              ELSE event_type || '_' || user_id % 50 END AS title,
         CAST(floor(value) AS BIGINT) AS views, strftime(ts, '%Y%m%d-00') AS hour
  FROM events),
articles AS (
  SELECT * FROM pages
  WHERE lower(language) = 'en' AND title <> 'Main_Page' AND NOT starts_with(title, 'Special:'))
"""
_WEATHER = """
obs AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'US' ELSE 'CA' END || user_id AS station, strftime(ts, '%Y%m%d') AS date,
         event_type, CAST(floor(value) AS INT) AS value
  FROM events WHERE value <= 300)
"""
_COMMENTS = """
comments AS (
  SELECT event_type AS subreddit, 'u' || user_id AS author,
         CASE WHEN event_id % 7 > 0 THEN CAST(floor(value) AS BIGINT) - 48 END AS score
  FROM events)
"""

ORACLES = {
    "page_file_tops": f"""
WITH {_PAGES}
SELECT hour, title, views FROM (SELECT *, rank() OVER (PARTITION BY hour ORDER BY views DESC) AS place FROM articles)
WHERE place = 1
""",
    "page_maxima_tabbed": f"""
WITH {_PAGES}
SELECT hour, max(views) AS views FROM articles GROUP BY hour
""",
    "adjacency_files": """
SELECT CAST(p_partkey AS VARCHAR) AS source, CAST(unnest([2 * p_partkey + 1, 2 * p_partkey + 2,
       (7 * p_partkey + 3) % (SELECT count(*) FROM part)]) AS VARCHAR) AS dest
FROM part
""",
    "weather_etl_files": f"""
WITH {_WEATHER}
SELECT station, date, value / 10 AS TMAX FROM obs WHERE starts_with(station, 'CA') AND event_type = 'click'
""",
    "temperature_range_files": f"""
WITH {_WEATHER},
ranges AS (
  SELECT date, station, (max(value) FILTER (event_type = 'click') - min(value) FILTER (event_type = 'view')) / 10 AS range
  FROM obs GROUP BY date, station)
SELECT date, station, range FROM (SELECT *, rank() OVER (PARTITION BY date ORDER BY range DESC) AS place
                                  FROM ranges WHERE range IS NOT NULL)
WHERE place = 1
""",
    "comment_mean_files": f"WITH {_COMMENTS} SELECT subreddit, round(avg(score), 6) AS mean FROM comments GROUP BY subreddit",
    "comment_route_files": f"""
WITH {_COMMENTS}
SELECT CASE WHEN score >= 0 THEN 'positive' ELSE 'negative' END AS side,
       '["' || subreddit || '","' || author || '",' || score || ']' AS line
FROM comments WHERE contains(subreddit, 'e') AND score IS NOT NULL
""",
    "batched_store": "SELECT p_partkey, p_name, p_brand, true AS sizes_fit FROM part",
    "log_store": """
WITH lines AS (
  SELECT 'h' || user_id AS host, date_trunc('second', ts) AS t, '/' || event_type || '/' || event_id AS path,
         CAST(floor(value * 10) AS BIGINT) AS bytes
  FROM events WHERE event_type <> 'error')
SELECT host, sha256('{"host":"' || host || '","datetime":"' || strftime(t, '%Y-%m-%dT%H:%M:%S.000Z') || '","path":"' || path
       || '","bytes":' || bytes || '}') AS id, strftime(t, '%Y-%m-%d %H:%M:%S') AS datetime, path, bytes
FROM lines
""",
}
