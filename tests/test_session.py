import pytest

from quernel import session


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)


class FakeSpark:
    """Only what shared_folder asks of a session."""

    def __init__(self, master, folder=None):
        self.conf = FakeConf({"spark.checkpoint.dir": folder} if folder else {})
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_the_cluster_names_the_folder():
    assert session.shared_folder(FakeSpark("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSpark("yarn"))


def test_local_folder_is_made_once(spark):
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_materialize(spark):
    df = session.materialize(spark.range(5), "t")
    assert df.count() == 5 and all("quernel" in f for f in df.inputFiles())


def test_even_out_only_widens(spark):
    narrow, wide = spark.range(0, 10, 1, 2), spark.range(0, 10, 1, 40)
    assert session.even_out(narrow, 6).rdd.getNumPartitions() == 6
    assert session.even_out(wide, 6) is wide


def test_what_is_worth_spreading():
    full = {f"/in/{i}.txt": 128 << 20 for i in range(20)}
    assert not session.worth_spreading(full, 128 << 20)
    assert session.worth_spreading({"/in/a.txt": 100 << 20}, 128 << 20)
    # Four long gzip files are four tasks; short ones are no burden.
    assert session.worth_spreading({f"/in/{i}.gz": 900 << 20 for i in range(4)}, 128 << 20)
    assert not session.worth_spreading(full | {"/in/x.gz": 9 << 20}, 128 << 20)
    assert not session.worth_spreading({f"/in/{i}.snappy.parquet": 900 << 20 for i in range(4)}, 128 << 20)
    assert [session._bytes(t) for t in ("134217728b", "128MB", "16m", "1g", "7")] == [1 << 27, 1 << 27, 1 << 24, 1 << 30, 7]


def test_few_gzip_files_are_spread_and_full_splits_left(spark, tmp_path, monkeypatch):
    lines = spark.range(3000).selectExpr("CAST(id AS string) AS value")
    lines.coalesce(2).write.text(str(tmp_path / "gz"), compression="gzip")
    lines.coalesce(1).write.text(str(tmp_path / "plain"))
    packed, plain = spark.read.text(str(tmp_path / "gz")), spark.read.text(str(tmp_path / "plain"))
    monkeypatch.setattr(session, "SMALL_INPUT", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        assert packed.rdd.getNumPartitions() == 2
        assert session.even_out(packed).rdd.getNumPartitions() == cores
        assert session.even_out(plain) is plain
        assert session.even_out(plain, 50).rdd.getNumPartitions() == 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cached_releases(spark):
    df = spark.range(3)
    with session.cached(df) as c:
        assert c.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_defaults_do_not_override_the_deployer(spark, monkeypatch):
    monkeypatch.setattr(session, "DEFAULTS", {"spark.sql.shuffle.partitions": "99"})
    assert session.get_spark("again").conf.get("spark.sql.shuffle.partitions") == "4"


def test_spread_is_by_rows_and_cores(spark, monkeypatch):
    """At least a partition per core and no more rows in one than are set, whatever the input's partitions."""
    cores = spark.sparkContext.defaultParallelism
    for df in (spark.range(1000).coalesce(1), spark.range(1000).repartition(50), spark.range(0)):
        assert session.spread(df).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    many = session.spread(spark.range(1000).coalesce(1))
    sizes = [len(part) for part in many.rdd.glom().collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 110
    assert many.distinct().count() == 1000
