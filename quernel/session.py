"""Session defaults, the shared scratch folder, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the defaults above, where neither ``settings`` nor the deployer sets them.

    Executor counts and memory are left to spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for name, value in DEFAULTS.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach.

    The cluster names it in spark.checkpoint.dir. Only a local session, where
    one machine holds everything, may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quernel-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/quernel/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the true
    size of the table, so its own broadcast threshold is a checked one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Inputs up to this size are spread whenever there are more cores than splits.
SMALL_INPUT = 1 << 30
#: Suffixes of files that are read by one task, however long they are.
ONE_TASK = (".gz", ".zip", ".deflate", ".snappy", ".lz4", ".zst")


def worth_spreading(lengths: dict[str, int], split_bytes: int) -> bool:
    """Whether files with fewer splits than cores should be shuffled, by their names and lengths.

    A small input is cheap to move and gets all cores. Of a large one every task has at most
    ``split_bytes`` already, and moving all of it would cost more than idle cores do,
    unless it holds a file that can't be split and is longer than that.
    """
    if sum(lengths.values()) <= SMALL_INPUT:
        return True
    # A codec inside a columnar file does not keep it in one piece.
    whole = [n for name, n in lengths.items() if name.endswith(ONE_TASK) and not name.endswith((".snappy.parquet", ".snappy.orc"))]
    return any(n > split_bytes for n in whole)


def _bytes(text: str) -> int:
    """Bytes of a setting such as ``128MB``, ``16m`` or ``1048576b``."""
    units = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}
    number = text.lower().removesuffix("b")
    unit = number[-1] if number[-1].isalpha() else ""
    return int(number.removesuffix(unit)) << units[unit]


def even_out(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Repartition only when the input has too few splits to keep the cores busy and moving it pays.

    A few gzip files, or one file with one row group, give one task each; big
    splittable inputs already have tasks of a fit size and are left alone. A number of
    ``partitions`` that is asked for is given to every input with fewer.
    """
    spark = df.sparkSession
    wanted = partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    files = df.inputFiles()
    if files and not partitions:
        # Lengths come from the listing; the contents are not read. There are fewer files than cores.
        found = spark.read.format("binaryFile").load(files).select("path", "length").collect()
        lengths = {r.path: r.length for r in found}
        if not worth_spreading(lengths, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))):
            return df
    return df.repartition(wanted)


#: Rows of a task at most in work that passes over all rows many times.
TASK_ROWS = 200_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in equal partitions: one per core at least, and more where one would exceed ``TASK_ROWS``.

    For rows that take little room and much work, such as those a model is fitted on. The size of
    their files, by which scans and the adaptive planner cut, then says nothing about the time of a task.
    ``rows`` is their number where it is known; otherwise they are counted.
    """
    rows = df.count() if rows is None else rows
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


class cached:
    """``with cached(df) as c:`` keeps ``c`` in memory or on disk for the block."""

    def __init__(self, df: DataFrame):
        self._df = df

    def __enter__(self) -> DataFrame:
        return self._df.persist(StorageLevel.MEMORY_AND_DISK)

    def __exit__(self, *_exc) -> None:
        self._df.unpersist()
