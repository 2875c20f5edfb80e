"""Every job from its command line, on small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from quernel.jobs import __main__ as cli


@pytest.fixture
def job(spark):
    return lambda *argv: cli.run(spark, cli.build_parser().parse_args([str(a) for a in argv]))


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))
    return path


def lines(folder):
    out = []
    for part in sorted(folder.rglob("part-*")):
        data = gzip.decompress(part.read_bytes()) if part.suffix == ".gz" else part.read_bytes()
        out += data.decode().splitlines()
    return out


def objects(folder):
    return [json.loads(line) for line in lines(folder)]


def test_word_count(job, tmp_path):
    text = put(tmp_path / "in.txt", "b a b.", "", "B-a")
    job("word-count", text, tmp_path / "plain")
    assert lines(tmp_path / "plain") == ["B-a 1", "a 1", "b 1", "b. 1"]
    job("word-count", text, tmp_path / "folded", "--punctuation", "--partitions", "2")
    assert lines(tmp_path / "folded") == ["a 2", "b 3"]
    job("word-count", text, tmp_path / "tabs", "--punctuation", "--ascii-space", "--tabbed")
    assert lines(tmp_path / "tabs") == ["a\t2", "b\t3"]


@pytest.fixture
def comments(tmp_path):
    data = [("teal", "u1", 4), ("teal", "u2", 2), ("b", "u3", 5), ("cee", "u4", -1), ("cee", "u5", 1)]
    rows = [json.dumps({"subreddit": s, "author": a, "score": v, "ups": 1}) for s, a, v in data]
    return put(tmp_path / "comments.json", *rows, json.dumps({"subreddit": "teal", "author": "u6"}))


def test_comment_jobs(job, comments, tmp_path):
    job("comment-means", comments, tmp_path / "csv")
    assert sorted(lines(tmp_path / "csv")) == ["b,5.0", "cee,0.0", "teal,3.0"]
    job("comment-means", comments, tmp_path / "json", "--style", "json")
    assert objects(tmp_path / "json") == [["b", 5.0], ["cee", 0.0], ["teal", 3.0]]
    job("comment-means", comments, tmp_path / "tabs", "--style", "tabbed")
    assert lines(tmp_path / "tabs") == ["b\t5.0", "cee\t0.0", "teal\t3.0"]
    for strategy in ("auto", "broadcast", "shuffle", "window"):
        job("relative-scores", comments, tmp_path / strategy, "--strategy", strategy)
        scored = objects(tmp_path / strategy)
        assert scored[0] == ["u1", 4 / 3] and scored[1:3] == [["u3", 1.0], ["u2", 2 / 3]]


def test_explain(job, comments, tmp_path, capfd):
    job("--explain", "comment-means", comments, tmp_path / "out")
    plan = capfd.readouterr().out
    assert "partial_avg(score" in plan and "ReadSchema: struct<score:bigint,subreddit:string>" in plan


def test_comment_routes(job, comments, tmp_path):
    up = [["cee", "u5", 1], ["teal", "u1", 4], ["teal", "u2", 2]]
    job("comment-routes", comments, tmp_path / "one")
    assert sorted(objects(tmp_path / "one" / "route=positive")) == up
    assert objects(tmp_path / "one" / "route=negative") == [["cee", "u4", -1]]
    job("comment-routes", comments, tmp_path / "two", "--folders")
    assert sorted(objects(tmp_path / "two" / "positive")) == up
    assert objects(tmp_path / "two" / "negative") == [["cee", "u4", -1]]


def test_page_jobs(job, tmp_path):
    body = ["en Apple 9 100", "EN Pear 9 80", "en Main_Page 99 1", "en Special:X 50 1", 'en "q 3 1', "fr Pomme 70 1"]
    rows = put(tmp_path / "rows.txt", *[f"20160801-12 {line}" for line in body])
    job("page-maxima", rows, tmp_path / "max")
    assert lines(tmp_path / "max") == ["20160801-12\t9"]
    job("page-tops", rows, tmp_path / "top", "--single-file")
    assert lines(tmp_path / "top") == ["20160801-12 \t (9, Apple)"]
    job("page-tops", rows, tmp_path / "tabbed", "--tabbed")
    assert lines(tmp_path / "tabbed") == ["20160801-12\t(Apple,9)"]
    folder = tmp_path / "files"
    folder.mkdir()
    for hour, extra in (("12", []), ("13", ["en Kiwi 9 1"])):
        text = "".join(f"{line}\n" for line in body + extra)
        (folder / f"pagecounts-20160801-{hour}0000.gz").write_bytes(gzip.compress(text.encode()))
    job("page-tops-by-file", folder, tmp_path / "byfile")
    assert [tuple(o.values()) for o in objects(tmp_path / "byfile")] == [
        ("20160801-12", "Apple", 9),
        ("20160801-13", "Apple", 9),
        ("20160801-13", "Kiwi", 9),
    ]
    job("page-tops-by-file", folder, tmp_path / "folded", "--fold")
    assert len(objects(tmp_path / "folded")) == 5


def test_weather_jobs(job, tmp_path):
    obs = put(
        tmp_path / "obs.csv",
        "CA1,20160501,TMAX,200,,,C,",
        "CA1,20160501,TMIN,100,,,C,",
        "CA2,20160501,TMAX,150,,,C,",
        "CA2,20160501,TMIN,50,,,C,",
        "CA3,20160501,TMAX,900,,X,C,",
        "CA3,20160501,TMIN,50,,,C,",
        "US1,20160501,TMAX,90,,,C,",
    )
    job("weather-etl", obs, tmp_path / "etl")
    got = sorted((o["station"], o["date"], o["TMAX"]) for o in objects(tmp_path / "etl"))
    assert got == [("CA1", "20160501", 20.0), ("CA2", "20160501", 15.0)]
    for form in ([], ["--sql"]):
        out = tmp_path / f"ranges{len(form)}"
        job("temperature-ranges", obs, out, *form)
        assert lines(out) == ["20160501,CA1,10.0", "20160501,CA2,10.0"]


LOG = '{} - - [01/Jul/1995:00:00:0{} -0400] "GET /x HTTP/1.0" 200 {}'


def test_log_jobs(job, spark, tmp_path, capfd):
    folder = tmp_path / "logs"
    folder.mkdir()
    text = [LOG.format("a", 1, 10), LOG.format("a", 2, 20), LOG.format("b", 3, 5), "junk", LOG.format("c", 4, "-")]
    (folder / "x.gz").write_bytes(gzip.compress("\n".join(text).encode()))
    job("correlate-logs", folder)
    store = tmp_path / "store" / "logs.parquet"
    job("load-logs", folder, "--path", store, "--partitions", 2)
    job("load-logs", folder, "--path", store)
    table = spark.read.parquet(str(store))
    assert table.columns == ["host", "id", "datetime", "path", "bytes"]
    assert sorted((r.host, r.bytes) for r in table.collect()) == [("a", 10), ("a", 20), ("b", 5)]
    job("correlate-table", "logs", "--folder", tmp_path / "store")
    assert capfd.readouterr().out.count("|1.0|1.0|") == 2


def test_shortest_path_job(job, tmp_path):
    graph = put(tmp_path / "links.txt", "1: 2 3", "2: 4", "3: 4", "4: 1 5", "6:")
    job("shortest-path", graph, tmp_path / "a", 1, 5, "--debug")
    assert lines(tmp_path / "a" / "path") == ["1", "2", "4", "5"]
    assert (tmp_path / "a" / "iter-0").exists()
    job("shortest-path", graph, tmp_path / "b", 1, 6)
    assert lines(tmp_path / "b" / "path") == ["no path exists from node 1 to node 6!"]


def test_order_jobs(job, spark, tmp_path):
    spark.createDataFrame([(1, 10.5, "x"), (2, 20.0, "y")], "orderkey int, totalprice double, comment string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 5), (1, 6), (2, 6)], "orderkey int, partkey int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5, "nut"), (6, "bolt")], "partkey int, name string").write.parquet(f"{tmp_path}/part.parquet")
    job("order-report", tmp_path / "joined", 2, 1, "--folder", tmp_path)
    assert lines(tmp_path / "joined") == ["Order #1 $10.50: bolt, nut", "Order #2 $20.00: bolt"]
    job("denormalize", "--folder", tmp_path, "--path", tmp_path / "orders_parts.parquet")
    job("order-lookup", tmp_path / "wide", 1, "--folder", tmp_path)
    assert lines(tmp_path / "wide") == ["Order #1 $10.50: bolt, nut"]
    assert spark.read.parquet(f"{tmp_path}/orders_parts.parquet").columns == ["orderkey", "totalprice", "comment", "part_names"]


def test_stream_job(spark, tmp_path):
    from quernel.jobs import tables

    df = spark.range(10).select(F.encode(F.concat_ws(" ", F.col("id"), F.col("id") * 2), "utf-8").alias("value"))
    df.write.parquet(str(tmp_path / "s"))
    tables.stream_line(spark, "parquet", 8, "noop", str(tmp_path / "s"), df.schema)
    assert not spark.streams.active


def test_stream_job_goes_on_where_it_stopped(job, tmp_path, capfd):
    def run():
        job(
            "stream-line", "--format", "text", "--path", tmp_path / "in", "--schema", "value string", "--once",
            "--ledger", tmp_path / "ledger", "--checkpoint", tmp_path / "checkpoint",
        )
        return capfd.readouterr().out

    put(tmp_path / "in" / "a.txt", "1 2", "2 4", "x")
    assert "|2.0 |0.0  |" in run()
    put(tmp_path / "in" / "b.txt", "3 6", "4 9")
    # The line of all four points: slope 2.3, intercept -0.5.
    assert "|2.3 |-0.5 |" in run()
    assert "|2.3 |-0.5 |" in run()


def test_wide_table_commands(job, spark, tmp_path):
    tables = tmp_path / "tables"
    orders = [(i, float(i), "x") for i in range(1, 30)]
    spark.createDataFrame(orders, "orderkey int, totalprice double, comment string").write.parquet(f"{tables}/orders.parquet")
    lines_ = [(i, 5) for i in range(1, 30)] + [(7, 6), (8, 6)]
    spark.createDataFrame(lines_, "orderkey int, partkey int").write.parquet(f"{tables}/lineitem.parquet")
    part = spark.createDataFrame([(5, "nut"), (6, "bolt")], "partkey int, name string")
    part.write.parquet(f"{tables}/part.parquet")
    job("wide-create", tmp_path / "wide", "--folder", tables, "--buckets", 8)
    job("wide-lookup", tmp_path / "wide", tmp_path / "one", 7, 9, 99, "--buckets", 8)
    assert lines(tmp_path / "one") == ["Order #7 $7.00: bolt, nut", "Order #9 $9.00: nut"]
    spark.createDataFrame([(5, "nut"), (6, "rod")], "partkey int, name string").write.mode("overwrite").parquet(f"{tables}/part.parquet")
    job("wide-refresh", tmp_path / "wide", 6, "--folder", tables, "--buckets", 8)
    job("wide-lookup", tmp_path / "wide", tmp_path / "two", 7, 9, "--buckets", 8)
    assert lines(tmp_path / "two") == ["Order #7 $7.00: nut, rod", "Order #9 $9.00: nut"]


def test_colour_job(job, spark, tmp_path, capfd):
    rows = [f"{i * 11 % 256},{i * 5 % 200},{i * 3 % 200},{w},good" for i in range(90) for w in ["red" if i * 11 % 256 > 99 else "blue"]]
    put(tmp_path / "colours.csv", *rows)
    job("train-colours", tmp_path / "colours.csv", "--kind", "logistic", "--seed", 1, "--grid", tmp_path / "grid")
    out = capfd.readouterr().out
    assert "rgb" in out and "lab" in out
    assert spark.read.parquet(f"{tmp_path}/grid/lab").count() == 256 * 256


def test_tmax_jobs(job, tmp_path, capfd):
    rows = [f"s{s},2019-{m:02d}-{d:02d},49.2,-122.9,33.0,{m + d % 3}.5" for s in (1, 2) for m in (1, 5, 9) for d in range(1, 28)]
    put(tmp_path / "tmax.csv", *rows)
    job("train-tmax", tmp_path / "tmax.csv", tmp_path / "model", "--iterations", 3, "--depth", 4)
    job("test-tmax", tmp_path / "model", tmp_path / "tmax.csv")
    job("predict-tmax", tmp_path / "model", "2019-10-08", 49.2, -122.9, 33.0, 12.0)
    out = capfd.readouterr().out
    assert out.count("rmse") == 2 and "yesterday_tmax" in out and "2019-10-09" in out
