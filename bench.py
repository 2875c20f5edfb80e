"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores.
Every query is run whole: its result is written to a sink that discards it.
BENCH_QUERIES may name a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quernel.operators import denorm
from quernel.plans import all_queries
from quernel.plans.tables import table
from quernel.session import get_spark, materialize

HEADLINE = [
    "word_count_ws",
    "word_count",
    "group_mean",
    "group_max",
    "top_one",
    "top_ties",
    "top_ties_shuffle",
    "top_ties_window",
    "relative_score",
    "relative_score_bcast",
    "relative_score_window",
    "etl_split",
    "observation_etl",
    "log_etl",
    "temp_range",
    "temp_range_sql",
    "correlate",
    "correlate_logs",
    "adjacency_edges",
    "shortest_hops",
    "order_parts",
    "orders_denorm",
    "orders_denorm_report",
    "dearest_orders_report",
    "denorm_refresh",
    "lag_day_join",
    "lag_day_window",
    "stream_regression",
    "rgb_to_lab",
    "rgb_to_hsv",
    "partition_partials",
    "json_field",
    "next_day_regressor",
    "colour_classifier_lab",
]


def keyed_reports(spark, folder):
    """Report of five orders from a wide table that is there already, not timed."""
    renamed = {"o_orderkey": "orderkey", "o_totalprice": "totalprice"}
    orders = table(spark, folder, "orders").withColumnsRenamed(renamed)
    lines = table(spark, folder, "lineitem").selectExpr("l_orderkey AS orderkey", "l_partkey AS partkey")
    parts = table(spark, folder, "part").selectExpr("p_partkey AS partkey", "p_name AS name")
    wide = materialize(denorm.denormalize(orders, lines, parts), "wide-orders")
    keys = [row.orderkey for row in orders.orderBy("totalprice").limit(5).collect()]
    joined = lambda: denorm.order_report_joined(orders, denorm.lines_of(lines, keys), parts, keys)
    return {"report_5_keys_joined": joined, "report_5_keys_wide": lambda: denorm.order_report(wide, keys)}


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # One small query first, so that no timing carries the start of the engine.
    discard(queries["group_mean"](spark, folder))
    runs = {name: (lambda q=queries[name]: q(spark, folder)) for name in names}
    if not chosen:
        runs.update(keyed_reports(spark, folder))
    times = {}
    for name, run in runs.items():
        start = time.perf_counter()
        discard(run())
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
