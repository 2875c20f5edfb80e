import pytest
from pyspark.sql import functions as F

from quernel.operators import stats
from quernel.streaming import line


def test_messages(spark):
    data = [(b"1 2",), (b"3",), (b"x 4",), (b"",), (b"5 6.5",)]
    xy = line.points(spark.createDataFrame(data, "value binary"))
    assert [tuple(r) for r in xy.collect()] == [(1, 2), (3, None), (None, 4), (None, None), (5, 6.5)]


@pytest.mark.parametrize("by_sums", [False, True])
def test_stream_of_several_files_equals_batch(spark, tmp_path, by_sums):
    path = str(tmp_path / "in")
    rows = spark.range(300).select(
        F.encode(F.concat_ws(" ", F.col("id") % 17, (F.col("id") * 3 % 101)), "utf-8").alias("value")
    )
    rows.repartition(5).write.parquet(path)
    stream = line.open_stream(spark, "parquet", path, rows.schema, maxFilesPerTrigger="2")
    got = line.run_available(line.running_line(line.points(stream), by_sums))
    want = stats.fitted_line(line.points(rows)).first()
    assert got.count() == 1
    assert tuple(got.first()) == pytest.approx(tuple(want))


def test_one_message_has_no_line(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.createDataFrame([(b"1 2",)], "value binary")
    rows.write.parquet(path)
    stream = line.open_stream(spark, "parquet", path, rows.schema)
    assert tuple(line.run_available(line.running_line(line.points(stream))).first()) == (None, None)
