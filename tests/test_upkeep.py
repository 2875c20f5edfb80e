"""Ledger of a stream, versions of a wide table, proofs of order."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quernel.operators import order, stats, versions
from quernel.streaming import ledger, line


def messages(spark, ids):
    xy = F.concat_ws(" ", F.col("id") % 17, F.col("id") * 3 % 101)
    return ids.select(F.encode(xy, "utf-8").alias("value"))


def test_stop_add_a_file_and_restart(spark, tmp_path):
    files, book, checkpoint = (str(tmp_path / name) for name in ("in", "ledger", "checkpoint"))
    done = []
    for low, high in ((0, 40), (40, 90), (90, 90), (90, 130)):
        if high > low:
            messages(spark, spark.range(low, high)).repartition(3).write.mode("append").parquet(files)
        stream = line.open_stream(spark, "parquet", files, "value binary", maxFilesPerTrigger="1")
        query = ledger.start(line.points(stream), book, checkpoint, roll=4, availableNow=True)
        query.awaitTermination()
        done.append(tuple(ledger.line_so_far(spark, book, 4).first()))
        want = stats.fitted_line(line.points(messages(spark, spark.range(high)))).first()
        assert done[-1] == pytest.approx(tuple(want))
    assert done[1] == done[2]
    # Nine files came one by one, so eight are rolled into one entry.
    assert sorted(r.batch for r in ledger.entries(spark, book, 4).collect()) == [8, 8]


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    book = str(tmp_path / "ledger")
    points = [line.points(messages(spark, spark.range(i * 10, i * 10 + 10))) for i in range(5)]
    for folder in ("batches/0", "rolled"):
        ledger._open(spark, f"{book}/{folder}")
    assert tuple(ledger.line_so_far(spark, book, 2).first()) == (None, None)
    for batch in (0, 0, 1, 1, 2, 3, 3, 4, 4):
        ledger.record(points[batch], batch, book, roll=2)
    want = stats.fitted_line(line.points(messages(spark, spark.range(50)))).first()
    assert tuple(ledger.line_so_far(spark, book, 2).first()) == pytest.approx(tuple(want))
    # Left by an attempt that died: a folder without a row.
    (tmp_path / "ledger" / "batches" / "2" / "5" / "_temporary").mkdir(parents=True)
    ledger.record(points[0], 5, book, roll=2)
    assert ledger.entries(spark, book, 2).agg(F.sum("n")).first()[0] == 60


@pytest.fixture
def base(spark):
    orders = spark.range(200).select(F.col("id").alias("orderkey"), (F.col("id") * 1.5).alias("totalprice"))
    # Part 0 is in every third order.
    lineitem = spark.range(600).select(
        (F.col("id") % 200).alias("orderkey"), F.when(F.col("id") % 200 % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("partkey")
    )
    part = spark.range(51).select(F.col("id").alias("partkey"), F.concat(F.lit("p"), "id").alias("name"))
    return orders, lineitem, part


def files_of(path):
    return {f.relative_to(path): (f.stat().st_mtime_ns, f.read_bytes()) for f in path.rglob("*.parquet")}


def state(df):
    return {r.orderkey: (r.totalprice, r.part_names) for r in df.collect()}


def test_untouched_buckets_stay_as_they_are(spark, tmp_path, base):
    from quernel.operators import denorm

    orders, lineitem, part = base
    table = versions.BucketedTable(spark, str(tmp_path / "wide"), "orderkey", 32)
    assert versions.create(table, orders, lineitem, part) == 1
    first = files_of(tmp_path)
    reader = table.read()
    before = state(reader)
    assert before == state(denorm.denormalize(orders, lineitem, part))
    after = part.withColumn("name", F.when(F.col("partkey") == 7, "new").otherwise(F.col("name")))
    assert versions.refresh(table, orders, lineitem, after, part.where("partkey = 7")) == 2
    # A reader that began with the first version goes on with it; a new one sees the second.
    assert state(reader) == before
    assert state(table.read()) == state(denorm.denormalize(orders, lineitem, after)) != before
    assert state(table.read(version=1)) == before
    now = files_of(tmp_path)
    assert {k: now[k] for k in first} == first
    _, old = table.folders(1)
    _, new = table.folders(2)
    assert 0 < sum(old[b] != new[b] for b in old) < 32
    assert state(table.look_up([5, 199, 1000])) == {k: state(table.read())[k] for k in (5, 199)}


def test_versions_when_all_is_gone_and_of_two_writers(spark, tmp_path, base):
    orders, lineitem, part = base
    table = versions.BucketedTable(spark, str(tmp_path / "wide"), "orderkey", 4)
    with pytest.raises(ValueError):
        table.read()
    versions.create(table, orders, lineitem, part)
    assert versions.refresh(table, orders, lineitem, part.limit(0), part) == 2
    assert table.folders() == (2, {}) and state(table.read(version=1))
    versions.create(table, orders.limit(3), lineitem, part)
    stale = versions.BucketedTable(spark, table.path, "orderkey", 4)
    stale.folders = lambda version=None: (2, {})
    with pytest.raises(AnalysisException):
        versions.create(stale, orders, lineitem, part)


def test_row_numbers_and_certificate(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("v"))
    done = order.placed(rows.repartitionByRange(5, "v", "k").sortWithinPartitions("v", "k"))
    got = sorted(order.row_numbers(done).collect(), key=lambda r: r.row_number)
    assert [r.row_number for r in got] == list(range(1, 1001))
    assert [(r.v is not None, r.v or 0, r.k) for r in got] == sorted((r.v is not None, r.v or 0, r.k) for r in got)
    proof = order.certificate(done, ["v", "k"]).collect()
    assert len(proof) > 1 and all(p.inside and p.after for p in proof) and sum(p.rows for p in proof) == 1000
    # Sorted inside, but parts overlap; and not sorted at all.
    parts = order.certificate(order.placed(rows.repartition(4, "k").sortWithinPartitions("k")), ["k"]).collect()
    assert all(p.inside for p in parts) and not all(p.after for p in parts)
    assert not all(p.inside for p in order.certificate(order.placed(rows.repartition(4)), ["k"]).collect())
    assert order.row_numbers(order.placed(rows.limit(0))).collect() == []
