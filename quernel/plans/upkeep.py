"""Results that are kept up: a wide table changed in place, a stream that is stopped and started again, rows in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.operators import aggregate, order, versions
from quernel.plans.orders import ORACLES as ORDER_SQL
from quernel.plans.orders import part_changes, wide_tables
from quernel.plans.series import ORACLES as SERIES_SQL
from quernel.plans.series import temp_range
from quernel.plans.streams import ORACLES as STREAM_SQL
from quernel.plans.tables import table
from quernel.plans.text import ORACLES as TEXT_SQL
from quernel.plans.text import word_count
from quernel.session import scratch_path
from quernel.streaming import ledger, line


def denorm_in_place(spark, folder):
    """The refresh of the wide table, by new versions of the buckets it touches."""
    orders, lineitem, part = wide_tables(spark, folder)
    orders = orders.select("orderkey", "totalprice")
    after, changed = part_changes(part)
    wide = versions.BucketedTable(spark, scratch_path(spark, "wide-versions"), "orderkey", buckets=16)
    versions.create(wide, orders, lineitem, part)
    versions.refresh(wide, orders, lineitem, after, changed)
    return wide.read().withColumn("part_names", F.array_join("part_names", ", "))


def stream_restart(spark, folder):
    """Two thirds of the messages, a stop, the others, and a start from the same checkpoint."""
    files, book, checkpoint = (scratch_path(spark, f"stream-{part}") for part in ("in", "ledger", "checkpoint"))
    events = table(spark, folder, "events")
    message = F.encode(F.concat_ws(" ", "user_id", "value"), "utf-8").alias("value")
    late = F.col("event_id") % 3 == 0
    for rows in (events.where(~late), events.where(late)):
        rows.select(message).write.mode("append").parquet(files)
        stream = line.open_stream(spark, "parquet", files, "value binary", maxFilesPerTrigger="4")
        ledger.start(line.points(stream), book, checkpoint, availableNow=True).awaitTermination()
    fitted = ledger.line_so_far(spark, book)
    return fitted.select(F.round("beta", 6).alias("beta"), F.round("alpha", 6).alias("alpha"))


def words_numbered(spark, folder):
    """Word counts in word order, with their place in it."""
    return order.row_numbers(order.placed(word_count(spark, folder)))


def ranges_numbered(spark, folder):
    """Daily ranges by date and station, with their place."""
    return order.row_numbers(order.placed(temp_range(spark, folder)))


def means_numbered(spark, folder):
    """Users by mean score, highest first, then by key."""
    score = F.floor("value").cast("bigint") - 48
    means = aggregate.mean_by(table(spark, folder, "events").withColumn("score", score), ["user_id"], "score")
    ranked = means.select("user_id", F.round("mean", 6).alias("mean")).orderBy(F.desc("mean"), "user_id")
    return order.row_numbers(order.placed(ranked))


def order_certified(spark, folder):
    """The sorted output proved: every partition in order, and every one after the one before."""
    proof = order.certificate(order.placed(word_count(spark, folder)), ["word"])
    return proof.agg(
        F.sum("rows").alias("rows"), F.min("inside").alias("inside"), F.min("after").alias("after"),
        F.min("first")["word"].alias("first"), F.max("last")["word"].alias("last"),
    )


def partitions_certified(spark, folder):
    """Parts by hash, each sorted: proved in order inside, with every key in one part."""
    quantity = F.sum("l_quantity").alias("quantity")
    sums = table(spark, folder, "lineitem").groupBy("l_partkey").agg(quantity)
    rows = order.placed(aggregate.sorted_partitions(sums, ["l_partkey"], 8))
    proof = order.certificate(rows, ["l_partkey"]).agg(F.sum("rows").alias("rows"), F.min("inside").alias("inside"))
    parts = rows.groupBy("l_partkey").agg(F.count_distinct("_part").alias("n"))
    return proof.join(F.broadcast(parts.agg((F.max("n") == 1).alias("keys_whole"))))


QUERIES = {
    "denorm_in_place": denorm_in_place,
    "stream_restart": stream_restart,
    "words_numbered": words_numbered,
    "ranges_numbered": ranges_numbered,
    "means_numbered": means_numbered,
    "order_certified": order_certified,
    "partitions_certified": partitions_certified,
}

_WORDS = f"words AS ({TEXT_SQL['word_count']})"

ORACLES = {
    "stream_restart": STREAM_SQL["stream_regression"],
    "words_numbered": f"WITH {_WORDS} SELECT *, row_number() OVER (ORDER BY word) AS row_number FROM words",
    "ranges_numbered": f"""
WITH ranges AS ({SERIES_SQL["temp_range"]}) SELECT *, row_number() OVER (ORDER BY date, station) AS row_number FROM ranges
""",
    "order_certified": f"""
WITH {_WORDS} SELECT count(*) AS rows, true AS inside, true AS after, min(word) AS first, max(word) AS last FROM words
""",
    "denorm_in_place": ORDER_SQL["denorm_refresh"],
    "means_numbered": """
WITH means AS (
  SELECT user_id, round(avg(CAST(floor(value) AS BIGINT) - 48), 6) AS mean FROM events GROUP BY user_id)
SELECT *, row_number() OVER (ORDER BY mean DESC, user_id) AS row_number FROM means
""",
    "partitions_certified": """
SELECT count(DISTINCT l_partkey) AS rows, true AS inside, true AS keys_whole FROM lineitem
""",
}
