"""Line dedup by range-partitioned hashes with a secondary sort.

Each line is a 128-bit hash of its key, its document and position; text is not
shuffled to find copies. The hashes are range-partitioned and sorted by
document (largest first) and position, and a window streams over each run: the
first document holds the first occurrences. The result is a keep bitmap per
document, run-length compressed to its runs of zeros, which is then applied to
the text.

A line that holds more than ``HOT`` of all occurrences would fill a range by
itself. There are at most 1 / ``HOT`` of them; what decides about them (least and largest
document, and whether another lies between) is aggregated before any shuffle
and broadcast, so their occurrences are not sorted at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.llm.common import ascii_lower, strip, whole
from quernel.operators.joins import measured_bytes
from quernel.session import materialize

#: Fixed values of the contract: code points of a key, and documents that hold it.
LEAST_LENGTH, LEAST_DOCS = 20, 3
HOT = 0.001

#: Measured bytes of all bitmaps up to which they are broadcast; larger ones meet the texts in a shuffle.
BROADCAST_BYTES = 32 << 20

_NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(strip(line))


def _row_keys(docs: DataFrame) -> list[Column]:
    """Names of a row: its id and a hash of its text, in case an id is repeated."""
    return [docs["doc_id"], F.hash(whole(docs["text"])).alias("text_hash")]


def occurrences(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(h1, h2, doc, doc_id, text_hash, pos) of each line with a long enough key."""
    lines = docs.select(*_row_keys(docs), F.split(whole(docs["text"]), "\n").alias("lines"))
    each = lines.select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
    keyed = each.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= least_length).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        F.coalesce("doc_id", F.lit(_NO_ID)).cast("bigint").alias("doc"), "doc_id", "text_hash", "pos",
    )


def dropped_lines(found: DataFrame, hot: float = HOT) -> DataFrame:
    """(doc_id, text_hash, pos) of all occurrences to drop, from ``occurrences``."""
    frequent = found.freqItems(["h1"], hot).select(F.explode("h1_freqItems").alias("h1")).distinct()
    frequent = F.broadcast(materialize(frequent, "line-hot"))

    rows = found.join(frequent, "h1", "left_semi")
    ends = rows.groupBy("h1", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    between = (F.col("doc") > F.col("low")) & (F.col("doc") < F.col("high"))
    many = rows.join(F.broadcast(ends), ["h1", "h2"]).groupBy("h1", "h2", "high").agg(F.bool_or(between).alias("third"))
    decided = F.broadcast(many.filter("third").select("h1", "h2", "high"))
    hot_drops = rows.join(decided, ["h1", "h2"]).filter("doc < high").select("doc_id", "text_hash", "pos")

    ranged = (
        found.join(frequent, "h1", "left_anti")
        .repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", F.desc("doc"), "pos")
    )
    run = Window.partitionBy("h1", "h2")
    streamed = ranged.withColumn("place", F.dense_rank().over(run.orderBy(F.desc("doc")))).withColumn(
        "low", F.min("doc").over(run)
    )
    # The second document's lines go only if there is a third.
    copies = streamed.filter("place > 2 OR (place = 2 AND low < doc)").select("doc_id", "text_hash", "pos")
    return hot_drops.union(copies)


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_dropped, zeros): per document the runs (first, n) of lines that go; all others stay."""
    document = Window.partitionBy("doc_id", "text_hash").orderBy("pos")
    runs = (
        dropped.distinct()
        .withColumn("island", F.col("pos") - F.row_number().over(document))
        .groupBy("doc_id", "text_hash", "island")
        .agg(F.min("pos").alias("first"), F.count("*").cast("int").alias("n"))
    )
    return runs.groupBy("doc_id", "text_hash").agg(
        F.sum("n").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("first", "n"))).alias("zeros")
    )


def _without(lines: Column, zeros: Column) -> Column:
    """The lines outside the runs, in one pass over both."""
    end = lambda r: r["first"] + r["n"]

    def before(run, i):
        start = F.when(i == 0, F.lit(0)).otherwise(end(F.get(zeros, i - 1)))
        return F.slice(lines, start + 1, run["first"] - start)

    last = end(F.element_at(zeros, -1))
    tail = F.slice(lines, last + 1, F.greatest(F.size(lines) - last, F.lit(0)))
    return F.flatten(F.concat(F.transform(zeros, before), F.array(tail)))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept), a row per row of ``docs``; ``kept`` is the text that stays.

    Bitmaps (a written table) of a measured size are sent to the texts, so that these stay where they are.
    """
    if measured_bytes(bitmaps) <= BROADCAST_BYTES:
        bitmaps = F.broadcast(bitmaps)
    text = whole("text")
    rows = docs.select(*_row_keys(docs), text.alias("text"))
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    short = F.array_join(_without(F.split("text", "\n"), F.col("zeros")), "\n")
    return (
        rows.alias("d")
        .join(
            bitmaps.alias("b"),
            F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_hash") == F.col("b.text_hash")),
            "left",
        )
        .select(
            "d.doc_id",
            n_lines.cast("bigint").alias("n_lines"),
            F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
            F.when(F.col("zeros").isNull(), F.col("text")).otherwise(short).alias("kept"),
        )
    )


def dedup_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept), a row per document.

    A key of at least ``least_length`` code points that at least three documents
    hold loses all its lines except in the one with the largest id. A null or empty text is one
    empty line. Rows that share an id count as one document; rows without an id count as one, the
    smallest. An empty table gives an empty table.
    """
    found = materialize(occurrences(docs, least_length), "line-hashes")
    bitmaps = materialize(keep_bitmaps(dropped_lines(found)), "line-bitmaps")
    return apply_bitmaps(docs, bitmaps)
