"""A wide table in key buckets that is kept up in place: copy on write, and one switch of version.

``path/data/<version>/bucket=<b>`` holds the rows of a bucket as some version wrote them.
``path/versions/<version>`` is a small table that says which folder each bucket is in. A new version
writes the buckets it changes and then, last, that small table. A reader takes the newest
one and so sees one version, before or after, never a mixture; folders of older
versions are not touched, so it may go on reading them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quernel.operators import denorm
from quernel.session import materialize

_FOLDERS = "version bigint, bucket bigint, folder bigint"


class BucketedTable:
    """A versioned table with one key column."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def bucket(self, key: Column | None = None) -> Column:
        """The bucket of a key; a null key has one too."""
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).alias("bucket")

    def folders(self, version: int | None = None) -> tuple[int, dict[int, int]]:
        """A version's number and the folder of each of its buckets; by default the newest; (0, {}) where there is none."""
        try:
            rows = self.spark.read.schema(_FOLDERS).option("recursiveFileLookup", "true").parquet(f"{self.path}/versions")
        except AnalysisException:
            return 0, {}
        if version is None:
            version = rows.agg(F.max("version")).first()[0] or 0
        mine = rows.where(F.col("version") == version).collect()
        return version, {r.bucket: r.folder for r in mine if r.bucket is not None}

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """Rows of a version; of some buckets only, where they are given."""
        _, held = self.folders(version)
        wanted = held if buckets is None else {b: held[b] for b in buckets if b in held}
        paths = [f"{self.path}/data/{folder}/bucket={b}" for b, folder in sorted(wanted.items())]
        if not paths:
            schema = self._schema(held)
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(*paths)

    def _schema(self, held: dict[int, int]):
        if not held:
            raise ValueError(f"no table at {self.path}")
        bucket, folder = next(iter(held.items()))
        return self.spark.read.parquet(f"{self.path}/data/{folder}/bucket={bucket}").schema

    def look_up(self, keys: Iterable) -> DataFrame:
        """Rows of some keys, read from their buckets alone."""
        _, held = self.folders()
        kind = self._schema(held)[self.key].dataType.simpleString()
        asked = [F.lit(key).cast(kind) for key in keys]
        if not asked:
            return self.read([])
        each = self.spark.range(1).select(F.explode(F.array(*asked)).alias("key")).select(self.bucket(F.col("key")))
        return denorm.with_keys(self.read({r.bucket for r in each.collect()}), self.key, keys)

    def commit(self, rows: DataFrame, changed: Iterable[int] | None = None) -> int:
        """Make ``rows`` the content of the ``changed`` buckets (all by default) in a new version; its number.

        Of two writers that start from the same version the second fails.
        """
        last, held = self.folders()
        version = last + 1
        target = f"{self.path}/data/{version}"
        split = rows.withColumn("bucket", self.bucket())
        # The rebalance hint sends a bucket's rows together and lets the planner split a large one.
        split.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        try:
            written = self.spark.read.parquet(target).select("bucket").distinct().collect()
        except AnalysisException:
            written = []  # no rows, no files
        gone = set(held) if changed is None else set(changed)
        now = {b: f for b, f in held.items() if b not in gone} | {int(r.bucket): version for r in written}
        # A version without rows is a row without a bucket.
        table = [(version, b, f) for b, f in sorted(now.items())] or [(version, None, None)]
        entry = self.spark.createDataFrame(table, _FOLDERS).coalesce(1)
        entry.write.mode("errorifexists").parquet(f"{self.path}/versions/{version}")
        return version


def create(table: BucketedTable, orders: DataFrame, lineitem: DataFrame, part: DataFrame, **names) -> int:
    """The wide order table as the next version, all buckets."""
    return table.commit(denorm.denormalize(orders, lineitem, part, **names))


def refresh(
    table: BucketedTable,
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    changed: DataFrame,
    part_key: str = "partkey",
    **names,
) -> int:
    """The next version after ``changed`` parts were inserted, renamed or deleted; the base tables are those after that.

    Only buckets with an order that uses a changed part are read and written.
    """
    touched = materialize(denorm.orders_using(lineitem, changed, table.key, part_key), "touched")
    buckets = [r.bucket for r in touched.select(table.bucket()).distinct().collect()]
    again = denorm.rebuild(table.read(buckets), orders, lineitem, part, touched, table.key, part_key, **names)
    return table.commit(again, buckets)
