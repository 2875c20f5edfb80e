"""Order reports, the denormalised table, and its refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.operators import denorm
from quernel.plans.tables import table
from quernel.session import materialize


def wide_tables(spark, folder):
    orders = table(spark, folder, "orders").withColumnsRenamed(
        {"o_orderkey": "orderkey", "o_totalprice": "totalprice"}
    )
    lineitem = table(spark, folder, "lineitem").withColumnsRenamed(
        {"l_orderkey": "orderkey", "l_partkey": "partkey"}
    )
    part = table(spark, folder, "part").withColumnsRenamed(
        {"p_partkey": "partkey", "p_name": "name"}
    )
    return orders, lineitem, part


def order_parts(spark, folder):
    orders, lineitem, part = wide_tables(spark, folder)
    return denorm.order_report_joined(orders, lineitem, part)


def _flat(wide):
    return wide.withColumn("part_names", F.array_join("part_names", ", "))


def orders_denorm(spark, folder):
    orders, lineitem, part = wide_tables(spark, folder)
    wide = denorm.denormalize(
        orders.withColumn("orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate"),
        lineitem,
        part,
    )
    return _flat(wide)


def orders_denorm_report(spark, folder):
    orders, lineitem, part = wide_tables(spark, folder)
    wide = materialize(denorm.denormalize(orders, lineitem, part), "orders-parts")
    return denorm.order_report(wide)


def dearest_orders_report(spark, folder):
    """Keyed look-up; the keys are the five dearest orders, like keys on a command line."""
    orders, lineitem, part = wide_tables(spark, folder)
    dearest = orders.orderBy(F.desc("totalprice"), "orderkey").limit(5)
    keys = [row.orderkey for row in dearest.select("orderkey").collect()]
    return denorm.order_report_joined(orders, denorm.lines_of(lineitem, keys), part, keys)


def part_changes(part):
    """The parts after one brand was renamed and another dropped, and the changed ones."""
    is_renamed = F.col("p_brand") == "Brand#11"
    is_deleted = F.col("p_brand") == "Brand#12"
    changed = part.where(is_renamed | is_deleted)
    after = part.where(~is_deleted).withColumn(
        "name", F.when(is_renamed, F.upper("name")).otherwise(F.col("name"))
    )
    return after, changed


def denorm_refresh(spark, folder):
    """Rename every part of one brand and drop another brand, then refresh."""
    orders, lineitem, part = wide_tables(spark, folder)
    orders = orders.select("orderkey", "totalprice")
    wide = materialize(denorm.denormalize(orders, lineitem, part), "orders-parts")
    after, changed = part_changes(part)
    return _flat(denorm.refresh(wide, orders, lineitem, after, changed))


def part_upsert(spark, folder):
    """Two versions of every part of some brands arrive; the last one written stays."""
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    some = part.where(F.col("p_brand") >= "Brand#2")
    versions = some.select("*", F.lit(1).alias("version")).unionByName(
        some.select(
            "p_partkey", F.upper("p_name").alias("p_name"), "p_brand", F.lit(2).alias("version")
        )
    )
    updates = denorm.latest(versions, ["p_partkey"], "version").drop("version")
    return denorm.upsert(part, updates, ["p_partkey"])


QUERIES = {
    "order_parts": order_parts,
    "orders_denorm": orders_denorm,
    "orders_denorm_report": orders_denorm_report,
    "dearest_orders_report": dearest_orders_report,
    "denorm_refresh": denorm_refresh,
    "part_upsert": part_upsert,
}

_REPORT = """
SELECT o_orderkey AS orderkey,
       format('Order #{{:d}} ${{:.2f}}: {{}}', o_orderkey, o_totalprice,
              string_agg(DISTINCT p_name, ', ' ORDER BY p_name)) AS line
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
{where}
GROUP BY o_orderkey, o_totalprice
"""

ORACLES = {
    "order_parts": _REPORT.format(where=""),
    "orders_denorm": """
SELECT o_orderkey AS orderkey, o_custkey, o_orderstatus, o_totalprice AS totalprice,
       o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS orderdate,
       string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS part_names
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY ALL
""",
    "orders_denorm_report": _REPORT.format(where=""),
    "dearest_orders_report": _REPORT.format(
        where="WHERE o_orderkey IN (SELECT o_orderkey FROM orders "
        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)"
    ),
    "denorm_refresh": """
WITH after AS (
  SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN upper(p_name) ELSE p_name END AS name
  FROM part WHERE p_brand <> 'Brand#12')
SELECT o_orderkey AS orderkey, o_totalprice AS totalprice,
       string_agg(DISTINCT name, ', ' ORDER BY name) AS part_names
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN after ON l_partkey = p_partkey
GROUP BY o_orderkey, o_totalprice
""",
    "part_upsert": """
SELECT p_partkey, CASE WHEN p_brand >= 'Brand#2' THEN upper(p_name) ELSE p_name END AS p_name, p_brand
FROM part
""",
}
