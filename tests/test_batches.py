import pytest
from pyspark.sql import functions as F

from quernel.sources import batches

SCHEMA = "id bigint, name string"


def rows(spark, low, high, parts):
    ids = spark.range(low, high, 1, parts)
    return ids.select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit('é "'), "id")).alias("name"))


def test_sizes_of_the_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    batches.save_batches(rows(spark, 0, 2100, 3), path)
    assert sorted(n for _, n in batches.listed(path)) == [200] * 3 + [250] * 6
    assert sorted(batches.load_batches(spark, path, SCHEMA).collect()) == sorted(rows(spark, 0, 2100, 1).collect())
    batches.save_batches(rows(spark, 2100, 2110, 1), path, batch=4, mode="append")
    assert sorted(n for _, n in batches.listed(path))[:3] == [2, 4, 4]
    assert batches.load_batches(spark, path, SCHEMA).count() == 2110
    batches.save_batches(rows(spark, 0, 1, 1), path, batch=4)
    assert [n for _, n in batches.listed(path)] == [1]


def test_an_aborted_write_counts_for_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    batches.save_batches(rows(spark, 0, 10, 1), path)
    bad = rows(spark, 0, 3000, 2).withColumn("name", F.when(F.col("id") == 2999, F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="no"):
        batches.save_batches(bad, path, mode="append")
    assert batches.load_batches(spark, path, SCHEMA).count() == 10


def test_empty_and_wrong(spark, tmp_path):
    path = str(tmp_path / "store")
    assert batches.listed(path) == [] and batches.load_batches(spark, path, SCHEMA).count() == 0
    batches.save_batches(rows(spark, 0, 0, 1), path)
    assert batches.load_batches(spark, path, SCHEMA).count() == 0
    with pytest.raises(Exception, match="one row at least"):
        batches.save_batches(rows(spark, 0, 5, 1), path, batch=0)
    uri = (tmp_path / "uri").as_uri()
    batches.save_batches(rows(spark, 0, 7, 1), uri, batch=3)
    assert [n for _, n in batches.listed(uri)] == [3, 3, 1]
    assert batches.load_batches(spark, uri, SCHEMA).count() == 7
