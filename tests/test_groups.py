import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from quernel.operators import aggregate, joins, relative, routing, topgroup
from quernel.session import materialize

PAGES = [
    ("h1", "en", "Apple", 9),
    ("h1", "EN", "Pear", 9),
    ("h1", "en", "Main_Page", 99),
    ("h1", "en", "Special:X", 50),
    ("h1", "fr", "Pomme", 70),
    ("h2", "en", "Zero", 0),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "hour string, language string, title string, views bigint")


@pytest.fixture
def comments(spark):
    data = [("a", "u1", 4), ("a", "u2", 2), ("b", "u3", 5), ("c", "u4", -1), ("c", "u5", 1), ("d", "u6", -3)]
    return spark.createDataFrame(data, "subreddit string, author string, score bigint")


def test_means_of_one_row_and_of_nulls(spark, comments):
    more = comments.union(spark.createDataFrame([("a", "u", None), (None, "u", 8)], comments.schema))
    got = {r[0]: r[1] for r in aggregate.mean_by(more, ["subreddit"], "score").collect()}
    assert got == {"a": 3.0, "b": 5.0, "c": 0.0, "d": -3.0, None: 8.0}


def test_articles(pages):
    assert rows(topgroup.article_rows(pages), "title") == [("Apple",), ("Pear",), ("Zero",)]
    assert rows(topgroup.article_rows(pages, fold=False), "title") == [("Apple",), ("Zero",)]


def test_max_with_floor(comments):
    got = rows(aggregate.max_by_group(comments, ["subreddit"], "score", floor=0))
    assert got == [("a", 4), ("b", 5), ("c", 1), ("d", 0)]


def test_top_rows_keep_all_ties(pages):
    articles = topgroup.article_rows(pages).select("hour", "title", "views")
    expected = [("h1", "Apple", 9), ("h1", "Pear", 9), ("h2", "Zero", 0)]
    for strategy in ("auto", "broadcast", "shuffle"):
        assert rows(topgroup.top_rows(articles, "hour", "views", strategy)) == expected
    assert rows(topgroup.top_rows_window(articles, "hour", "views")) == expected
    assert rows(topgroup.top_one(articles, "hour", "views", "title")) == [("h1", "Apple", 9), ("h2", "Zero", 0)]
    assert rows(topgroup.top_one(articles, "hour", "views", "title", floor=0)) == [
        ("h1", "Apple", 9),
        ("h2", "", 0),
    ]
    assert rows(topgroup.top_joined(articles, "hour", "views", "title")) == [
        ("h1", "Apple, Pear", 9),
        ("h2", "Zero", 0),
    ]


@pytest.mark.parametrize("hot_rows", [10**6, 100])
def test_top_rows_of_a_group_of_ties(spark, hot_rows):
    """A third of all rows tie in one group, and the maxima are too many to broadcast."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 80 + 1).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 11).alias("v"),
        "id",
    )
    expected = df.groupBy("g").agg(F.max("v").alias("v")).join(df, ["g", "v"])
    expected = rows(expected, "g", "v", "id")
    assert rows(topgroup.top_rows(df, "g", "v", "shuffle", hot_rows)) == expected
    assert rows(topgroup.top_rows_window(df, "g", "v", hot_rows, 0)) == expected


def test_relative_scores(comments):
    got = {r.author: r.relative for r in relative.relative_score(comments, "subreddit", "score").collect()}
    assert got == {"u1": 4 / 3, "u2": 2 / 3, "u3": 1.0}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle", "window"])
@pytest.mark.parametrize("hot_rows,limit", [(10**6, 1 << 26), (50, 0)])
def test_relative_strategies_agree_on_a_hot_group(spark, strategy, hot_rows, limit):
    """A third of the rows in one group, with small groups and non-positive means beside it."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7 + F.col("id") % 80).alias("g"),
        (F.col("id") * 37 % 11 - 3).alias("v"),
    )
    expected = df.groupBy("g").agg(F.avg("v").alias("m")).where("m > 0").join(df, "g")
    expected = rows(expected.select("g", "v", (F.col("v") / F.col("m")).alias("r")))
    got = relative.relative_score(df, "g", "v", "r", strategy, hot_rows, limit)
    assert rows(got, "g", "v", "r") == expected


def test_hot_keys_are_bounded(spark, monkeypatch):
    groups = spark.createDataFrame([(i, 100) for i in range(50)] + [(99, 5000)], "k int, n bigint")
    assert rows(joins.hot_keys(groups, ["k"], "n", 50)).__len__() == 51
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    assert rows(joins.hot_keys(groups, ["k"], "n", 50)) == [(99,)]


def test_lookup_join_plans(spark):
    rows_ = spark.range(100).withColumnRenamed("id", "k")
    lookup = materialize(spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "t")
    assert "BroadcastHashJoin" in plan_of(joins.lookup_join(rows_, lookup, ["k"]))
    assert "SortMergeJoin" in plan_of(joins.lookup_join(rows_, lookup, ["k"], limit=0))
    assert "SortMergeJoin" in plan_of(joins.lookup_join(rows_, lookup, ["k"], strategy="shuffle"))
    with pytest.raises(ValueError):
        joins.lookup_join(rows_, lookup, ["k"], strategy="other")


def test_sort_by_score_keeps_every_row(spark):
    df = spark.range(60).select((F.col("id") % 3).cast("double").alias("s"), F.lit("x").alias("a"))
    got = [r.s for r in relative.by_score(df, "s", "a").collect()]
    assert got == sorted(got, reverse=True) and len(got) == 60


def test_routes(comments):
    kept = routing.containing(comments.withColumn("subreddit", F.concat("subreddit", F.lit("e"))), "subreddit")
    up, down = routing.split_by_sign(kept, "score")
    assert (up.count(), down.count()) == (4, 2)
    assert routing.containing(comments, "subreddit", "A").count() == 0


def test_difference_is_distinct(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(aggregate.difference(left, right).collect(), key=str) == [(1,), (None,)]


def test_partials_and_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), "id")
    assert aggregate.sum_partials(df, "v").first() == (499500.0, 1000)
    parts = aggregate.sorted_partitions(df, ["id"], 3)
    tagged = parts.select(F.spark_partition_id().alias("p"), "id").collect()
    for p in range(3):
        ids = [r.id for r in tagged if r.p == p]
        assert ids == sorted(ids)
    assert {r.p for r in tagged} == {0, 1, 2} and len(tagged) == 1000
