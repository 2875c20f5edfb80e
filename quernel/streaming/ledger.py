"""A restartable running line: every micro-batch is entered once in a ledger of sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernel.operators.stats import line_of_sums, power_sums

#: So many batches are added up into one entry.
ROLL = 100
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
SCHEMA = "batch bigint, " + ", ".join(f"{c} double" for c in SUMS)


def _put(rows: DataFrame, path: str) -> None:
    """One small file; what a failed attempt left is replaced."""
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def _open(spark: SparkSession, path: str) -> None:
    """A folder that can be read before it has an entry."""
    _put(spark.createDataFrame([], SCHEMA), f"{path}/none")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def entries(spark: SparkSession, ledger: str, roll: int = ROLL) -> DataFrame:
    """The rows that make up the line: the latest rolled one and every batch after it."""
    rolled = _read(spark, f"{ledger}/rolled")
    upto = rolled.agg(F.max("batch")).first()[0]
    if upto is None:
        return _read(spark, f"{ledger}/batches/0")
    return rolled.where(F.col("batch") == upto).unionByName(_read(spark, f"{ledger}/batches/{upto // roll}"))


def record(points: DataFrame, batch: int, ledger: str, roll: int = ROLL) -> None:
    """Enter one micro-batch, number 0 first. A batch that comes again after a failure takes the place of itself.

    Batches of a group of ``roll`` share a folder; when it is full, its sums and those before
    it become one rolled entry, so a reader opens no more than ``roll`` entries.
    """
    spark = points.sparkSession
    sums = [F.coalesce(c, F.lit(0.0)).alias(c) for c in SUMS]
    number = F.lit(batch).cast("bigint").alias("batch")
    group, last = divmod(batch, roll)
    _put(power_sums(points).select(number, *sums), f"{ledger}/batches/{group}/{batch}")
    if last == roll - 1:
        before = _read(spark, f"{ledger}/rolled").where(F.col("batch") == batch + 1 - roll)
        whole = before.unionByName(_read(spark, f"{ledger}/batches/{group}"))
        _open(spark, f"{ledger}/batches/{group + 1}")
        # Numbered by the batch that comes next.
        row = whole.agg(F.lit(batch + 1).cast("bigint").alias("batch"), *[F.sum(c).alias(c) for c in SUMS])
        _put(row, f"{ledger}/rolled/{batch + 1}")


def start(points: DataFrame, ledger: str, checkpoint: str, roll: int = ROLL, **trigger) -> StreamingQuery:
    """Feed the ledger from a stream of ``x, y``.

    The checkpoint fixes which rows a batch has, the ledger that each batch counts once; started
    again with the same two, a query goes on where it stopped. One checkpoint belongs to one ledger,
    and ``roll`` stays what it was.
    """
    _open(points.sparkSession, f"{ledger}/batches/0")
    _open(points.sparkSession, f"{ledger}/rolled")
    writer = points.writeStream.foreachBatch(lambda rows, batch: record(rows, batch, ledger, roll))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def line_so_far(spark: SparkSession, ledger: str, roll: int = ROLL) -> DataFrame:
    """``beta, alpha`` of all points entered; nulls while there are none."""
    sums = entries(spark, ledger, roll).agg(*[F.sum(c).alias(c) for c in SUMS])
    return line_of_sums(sums)
