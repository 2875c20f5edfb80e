"""Fitted tree ensembles as a table of nodes, and scoring and importances from that table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.learning.layers import let
from quernel.session import scratch_path

#: Nodes that scoring holds at most; 20 trees of depth 10 have 40,940 or fewer.
MOST_NODES = 2_000_000


def nodes(model) -> DataFrame:
    """``tree, weight, node, feature, threshold, left, right, value, gain, rows`` of a fitted ensemble.

    From the tables the model itself writes. Leaves have no feature, threshold, children or gain.
    Splits on categories have no threshold and are refused.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata")
    weights = weights.select(F.col(weights.columns[0]).alias("tree"), F.col(weights.columns[2]).alias("weight"))
    data = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    if not data.where("split.numCategories > 0").isEmpty():
        raise ValueError("splits on categories are not supported")
    inner = F.col("leftChild") >= 0
    return data.join(F.broadcast(weights), "tree").select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"),
        F.when(inner, F.col("gain")).alias("gain"),
        F.col("impurityStats")[0].alias("rows"),
    )


def _flat(table: DataFrame):
    """Nodes in one list, children by place in it, with the roots and the greatest depth."""
    rows = table.orderBy("tree", "node").limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    place = {(r.tree, r.node): i for i, r in enumerate(rows)}
    flat, depth = [], [0] * len(rows)
    for r in rows:
        ends = [-1, -1] if r.left is None else [place[r.tree, r.left], place[r.tree, r.right]]
        flat.append({"f": r.feature, "t": r.threshold, "l": ends[0], "r": ends[1], "v": r.value})
    for i, node in enumerate(flat):
        # Children come after their parent.
        for end in (node["l"], node["r"]):
            if end >= 0:
                depth[end] = depth[i] + 1
    roots = [{"at": place[r.tree, 0], "w": r.weight} for r in rows if r.node == 0]
    return flat, roots, max(depth, default=0)


def score(table: DataFrame, features: Sequence[str]) -> Column:
    """The ensemble's prediction as a SQL expression over the feature columns.

    The nodes are one constant array. Every tree is walked from its root by as many steps as the
    deepest has levels; a leaf stays where it is. The weighted leaves are added up.
    """
    flat, roots, depth = _flat(table)
    forest = F.from_json(F.lit(json.dumps(flat)), "array<struct<f:int,t:double,l:int,r:int,v:double>>")
    starts = F.from_json(F.lit(json.dumps(roots)), "array<struct<at:int,w:double>>")
    values = F.array(*[F.col(c).cast("double") for c in features])
    steps = F.sequence(F.lit(0), F.lit(depth))

    def walk(tree, x, root):
        def step(at, _):
            node = F.get(tree, at)
            down = F.when(F.get(x, node["f"]) <= node["t"], node["l"]).otherwise(node["r"])
            return F.when(node["l"] < 0, at).otherwise(down)

        return F.aggregate(steps, root["at"], step)

    def total(tree, x):
        return F.aggregate(
            starts, F.lit(0.0), lambda sum_, root: sum_ + root["w"] * F.get(tree, walk(tree, x, root))["v"]
        )

    return let(forest, lambda tree: let(values, lambda x: total(tree, x)))


def importances(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, importance``: each feature's share of gain times rows over all splits; 0 if never split on."""
    spark = table.sparkSession
    names = spark.createDataFrame(list(enumerate(features)), "feature int, name string")
    gains = table.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    total = gains.agg(F.sum("g").alias("total"))
    share = F.coalesce(F.col("g") / F.col("total"), F.lit(0.0))
    # The model's features are few; their sum is one row.
    return names.join(gains, "feature", "left").join(F.broadcast(total)).select(
        F.col("name").alias("feature"), share.alias("importance")
    )
