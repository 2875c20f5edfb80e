import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from quernel.operators import denorm


@pytest.fixture
def base(spark):
    orders = spark.createDataFrame([(1, 10.5), (2, 20.0), (3, 7.25)], "orderkey int, totalprice double")
    lines = spark.createDataFrame(
        [(1, 5), (1, 5), (1, 6), (1, 7), (2, 6)], "orderkey int, partkey int"
    )
    parts = spark.createDataFrame([(5, "nut"), (6, "bolt"), (7, "nut")], "partkey int, name string")
    return orders, lines, parts


def test_report(base):
    expected = [(1, "Order #1 $10.50: bolt, nut"), (2, "Order #2 $20.00: bolt")]
    assert rows(denorm.order_report_joined(*base)) == expected
    assert rows(denorm.order_report(denorm.denormalize(*base))) == expected
    assert rows(denorm.order_report_joined(*base, keys=["2", "3", "9"])) == expected[1:]


def test_wide_table_equals_grouping_by_all_order_columns(base):
    orders, lines, parts = base
    joined = orders.join(lines, "orderkey").join(parts, "partkey").select(*orders.columns, "name")
    keys = [c for c in joined.columns if c != "name"]
    grouped = joined.groupBy(*keys).agg(F.array_sort(F.collect_set("name")).alias("part_names"))
    assert rows(denorm.denormalize(*base)) == rows(grouped)


def test_decimal_prices(base):
    orders, lines, parts = base
    orders = orders.withColumn("totalprice", F.col("totalprice").cast("decimal(38,18)"))
    assert rows(denorm.order_report_joined(orders, lines, parts))[0][1] == "Order #1 $10.50: bolt, nut"


def test_keys_reach_both_scans(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").selectExpr(
        "o_orderkey AS orderkey", "o_totalprice AS totalprice", "o_orderstatus"
    )
    lines = spark.read.parquet(f"{small}/lineitem.parquet").selectExpr(
        "l_orderkey AS orderkey", "l_partkey AS partkey", "l_quantity"
    )
    parts = spark.read.parquet(f"{small}/part.parquet").selectExpr("p_partkey AS partkey", "p_name AS name")
    plan = plan_of(denorm.order_report_joined(orders, lines, parts, ["5", "7"]))
    assert "In(o_orderkey, [5,7])" in plan and "In(l_orderkey, [5,7])" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "l_quantity" not in plan


def test_bad_key_is_an_error(base):
    with pytest.raises(Exception, match="CAST"):
        denorm.order_report_joined(*base, keys=["x"]).collect()


def test_refresh_equals_rebuild(base, spark):
    orders, lines, parts = base
    before = denorm.denormalize(*base)
    after = spark.createDataFrame([(5, "nut"), (6, "screw"), (8, "new")], parts.schema)
    changed = spark.createDataFrame([(6,), (7,), (8,)], "partkey int")
    got = denorm.refresh(before, orders, lines, after, changed)
    assert sorted(map(str, got.collect())) == sorted(
        map(str, denorm.denormalize(orders, lines, after).collect())
    )


def test_refresh_drops_orders_left_without_parts(base, spark):
    orders, lines, parts = base
    after = parts.where("partkey <> 6")
    got = denorm.refresh(denorm.denormalize(*base), orders, lines, after, parts.where("partkey = 6"))
    assert rows(got, "orderkey") == [(1,)]


def test_new_and_deleted_orders(base, spark):
    orders, lines, parts = base
    orders_after = orders.where("orderkey <> 1").union(spark.createDataFrame([(9, 1.0)], orders.schema))
    lines_after = lines.where("orderkey <> 1").union(spark.createDataFrame([(9, 7)], lines.schema))
    touched = spark.createDataFrame([(1,), (9,)], "orderkey int")
    got = denorm.rebuild(denorm.denormalize(*base), orders_after, lines_after, parts, touched)
    assert rows(got) == [(2, 20.0, ["bolt"]), (9, 1.0, ["nut"])]


def test_upsert_last_write_wins(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    writes = spark.createDataFrame([(2, "x", 1), (2, "y", 3), (2, "z", 2), (3, "n", 1)], "k int, v string, t int")
    updates = denorm.latest(writes, ["k"], "t").drop("t")
    assert rows(denorm.upsert(base, updates, ["k"])) == [(1, "a"), (2, "y"), (3, "n")]


def test_names_are_spread_before_they_are_collected(base):
    """The distinct over (order, name) stands between the lines and the collect."""
    plan = plan_of(denorm.part_names(base[1], base[2]), "simple")
    assert plan.count("hashpartitioning(orderkey#") >= 2
