"""Group means, maxima, top rows, relative scores, routing, set difference."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.functions.text import keyed_pair_line
from quernel.operators import aggregate, relative, routing, topgroup
from quernel.plans.tables import table
from quernel.session import scratch_path
from quernel.sources import save_routed


def _scores(spark, folder):
    """Integers keep sums exact; the shift leaves some means negative."""
    score = F.floor("value").cast("bigint") - 48
    events = table(spark, folder, "events")
    return events.select("event_id", "user_id", "event_type", score.alias("score"))


def _views(spark, folder):
    """Event types as pages, days as hours; days stay dates until they are shown."""
    day = F.to_date("ts")
    views = F.floor("value").cast("bigint")
    events = table(spark, folder, "events")
    return events.select("event_id", "event_type", day.alias("day"), views.alias("views"))


def _shown(df):
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def group_mean(spark, folder):
    return aggregate.mean_by(_scores(spark, folder), ["event_type"], "score", "mean_score")


def user_mean(spark, folder):
    return aggregate.mean_by(_scores(spark, folder), ["user_id"], "score", "mean_score").orderBy("user_id")


def group_max(spark, folder):
    views = _views(spark, folder)
    return _shown(aggregate.max_by_group(views, ["event_type", "day"], "views", "max_views"))


def group_max_floor(spark, folder):
    """Groups whose values never exceed zero give zero."""
    return aggregate.max_by_group(_scores(spark, folder), ["user_id"], "score", "max_score", floor=0)


def top_one(spark, folder):
    views = _views(spark, folder).withColumn("item", F.col("event_type"))
    return _shown(topgroup.top_one(views, "day", "views", "item", floor=0))


def top_one_lines(spark, folder):
    views = _views(spark, folder)
    best = topgroup.top_one(views, "day", "views", "event_type")
    return _shown(best.orderBy("day")).select(keyed_pair_line("day", "views", "event_type").alias("line"))


def top_ties(spark, folder):
    best = topgroup.top_rows(_views(spark, folder), "event_type", "views")
    return _shown(best.orderBy("event_type", "event_id"))


def top_ties_shuffle(spark, folder):
    return _shown(topgroup.top_rows(_views(spark, folder), "event_type", "views", strategy="shuffle"))


def top_ties_window(spark, folder):
    return _shown(topgroup.top_rows_window(_views(spark, folder), "event_type", "views"))


def top_ties_joined(spark, folder):
    views = _views(spark, folder).withColumn("item", F.concat(F.lit("e"), F.col("event_id")))
    return topgroup.top_joined(views, "event_type", "views", "item")


def _relative(strategy):
    def query(spark, folder):
        scores = _scores(spark, folder).select("event_id", "user_id", "score")
        out = relative.relative_score(scores, "user_id", "score", strategy=strategy)
        return relative.by_score(out, "relative", "event_id")

    return query


def etl_split(spark, folder):
    """Routed output written in one pass, then read back with its route."""
    rows = routing.containing(_scores(spark, folder), "event_type", "r")
    path = scratch_path(spark, "routed")
    save_routed(rows, routing.sign_route("score"), path)
    schema = "event_id bigint, user_id bigint, event_type string, score bigint, route string"
    return spark.read.schema(schema).json(path)


def observation_etl(spark, folder):
    """Orders as observations: priority as station, status as kind, high prices flagged."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("station"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderstatus").alias("observation"),
        F.col("o_totalprice").alias("value"),
        F.when(F.col("o_totalprice") > 400_000, F.lit("X")).alias("qflag"),
    )
    return routing.valid_observations(orders, prefix="1-", kind="F", out="price")


def except_users(spark, folder):
    events = table(spark, folder, "events")
    viewers = events.where(F.col("event_type") == "view").select("user_id")
    spenders = events.where(F.col("value") > 200).select("user_id")
    return aggregate.difference(viewers, spenders)


def partition_partials(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    return aggregate.sum_partials(lineitem, "l_quantity")


def sorted_partitions(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    totals = lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    parts = aggregate.sorted_partitions(totals, ["l_partkey"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    return parts


QUERIES = {
    "group_mean": group_mean,
    "user_mean": user_mean,
    "group_max": group_max,
    "group_max_floor": group_max_floor,
    "top_one": top_one,
    "top_one_lines": top_one_lines,
    "top_ties": top_ties,
    "top_ties_shuffle": top_ties_shuffle,
    "top_ties_window": top_ties_window,
    "top_ties_joined": top_ties_joined,
    "relative_score": _relative("shuffle"),
    "relative_score_bcast": _relative("broadcast"),
    "relative_score_window": _relative("window"),
    "etl_split": etl_split,
    "observation_etl": observation_etl,
    "except_users": except_users,
    "partition_partials": partition_partials,
    "sorted_partitions": sorted_partitions,
}

_SCORES = "(SELECT event_id, user_id, event_type, CAST(floor(value) AS BIGINT) - 48 AS score FROM events)"
_VIEWS = """(SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
                    CAST(floor(value) AS BIGINT) AS views FROM events)"""
_TOP_TIES = f"""
SELECT event_id, event_type, day, views
FROM (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY views DESC) AS place FROM {_VIEWS})
WHERE place = 1
"""
_TOP_ONE = f"""
SELECT day, views, event_type
FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY views DESC, event_type) AS place FROM {_VIEWS})
WHERE place = 1
"""
_RELATIVE = f"""
SELECT event_id, s.user_id, score, score / mean AS relative
FROM {_SCORES} AS s
JOIN (SELECT user_id, avg(score) AS mean FROM {_SCORES} GROUP BY user_id) AS m ON s.user_id = m.user_id
WHERE mean > 0
"""

ORACLES = {
    "group_mean": f"SELECT event_type, avg(score) AS mean_score FROM {_SCORES} GROUP BY event_type",
    "user_mean": f"SELECT user_id, avg(score) AS mean_score FROM {_SCORES} GROUP BY user_id",
    "group_max": f"SELECT event_type, day, max(views) AS max_views FROM {_VIEWS} GROUP BY event_type, day",
    "group_max_floor": f"""
SELECT user_id, greatest(max(score), 0) AS max_score FROM {_SCORES} GROUP BY user_id
""",
    "top_one": f"""
SELECT day, greatest(views, 0) AS views, CASE WHEN views <= 0 THEN '' ELSE event_type END AS item
FROM ({_TOP_ONE})
""",
    "top_one_lines": f"SELECT day || ' \t (' || views || ', ' || event_type || ')' AS line FROM ({_TOP_ONE})",
    "top_ties": _TOP_TIES,
    "top_ties_shuffle": _TOP_TIES,
    "top_ties_window": _TOP_TIES,
    "top_ties_joined": f"""
SELECT event_type, views, string_agg(DISTINCT 'e' || event_id, ', ' ORDER BY 'e' || event_id) AS item
FROM ({_TOP_TIES}) GROUP BY event_type, views
""",
    "relative_score": _RELATIVE,
    "relative_score_bcast": _RELATIVE,
    "relative_score_window": _RELATIVE,
    "etl_split": f"""
SELECT event_id, user_id, event_type, score,
       CASE WHEN score >= 0 THEN 'positive' ELSE 'negative' END AS route
FROM {_SCORES} WHERE contains(event_type, 'r')
""",
    "observation_etl": """
SELECT o_orderpriority AS station, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice / 10 AS price
FROM orders
WHERE starts_with(o_orderpriority, '1-') AND o_orderstatus = 'F' AND o_totalprice <= 400000
""",
    "except_users": """
SELECT user_id FROM events WHERE event_type = 'view'
EXCEPT SELECT user_id FROM events WHERE value > 200
""",
    "partition_partials": "SELECT sum(l_quantity) AS total, count(*) AS rows FROM lineitem",
    "sorted_partitions": "SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey",
}
