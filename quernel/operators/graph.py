"""Edges from adjacency text, and shortest paths over an edge table."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.operators.joins import BROADCAST_BYTES, HOT_ROWS, hot_keys, row_bytes
from quernel.session import materialize, scratch_path

# Fixed value: the bound of the command-line job.
MAX_HOPS = 6


def edges(adjacency: DataFrame, source: str = "source", dest: str = "dest") -> DataFrame:
    """One row per edge from (node, ``n1 n2 ...``) rows; nodes without edges drop out."""
    each = adjacency.select(F.col(source), F.explode(F.split(dest, " +")).alias(dest))
    return each.where((F.col(dest) != "") & F.col(source).isNotNull())


#: Levels whose paths are put together before they are written.
CHAIN = 8


class Paths:
    """Levels of a breadth-first search: each a written table (node, parent, above).

    ``above`` is the rank of the parent's path among the paths of its level, so a
    level in order of (above, node) is in order of its paths. No path is kept: they are
    put together from the parents when they are asked for. ``bound`` is the number of edges
    at which the search was stopped, or None if it went on until it had what it was to find.
    """

    def __init__(self, levels: list[DataFrame], bound: int | None = None):
        self._levels = levels
        self.bound = bound

    def _tagged(self, levels, *columns) -> DataFrame:
        tagged = [level.select(*columns, F.lit(hops).alias("hops")) for hops, level in enumerate(levels)]
        out = tagged[0]
        for level in tagged[1:]:
            out = out.union(level)
        return out

    def hops(self) -> DataFrame:
        """``node, hops``: least number of edges, one row per reached node."""
        return self._tagged(self._levels, "node")

    def paths(self) -> DataFrame:
        """``node, path, hops``: of all shortest paths, the smallest array."""
        done = [self._levels[0].select("node", F.array("node").alias("path"))]
        for hops, level in enumerate(self._levels[1:], 1):
            above = done[-1].select(F.col("node").alias("parent"), "path")
            joined = level.join(above, "parent").select("node", F.concat("path", F.array("node")).alias("path"))
            done.append(joined if hops % CHAIN else materialize(joined, "paths"))
        return self._tagged(done, "node", "path")

    def parents(self) -> DataFrame:
        """``node, source, distance``: the node before each node; null at the start."""
        return self._tagged(self._levels, "node", "parent").select(
            "node", F.col("parent").alias("source"), F.col("hops").alias("distance")
        )

    def path_to(self, node) -> DataFrame:
        """``node, path, hops`` of one node, or no row: one look-up per level, from the node back to the start."""
        kind = self._levels[0].schema["node"].dataType.simpleString()
        spark = self._levels[0].sparkSession
        back, at = [], None
        for hops in range(len(self._levels) - 1, -1, -1):
            wanted = F.lit(node).cast(kind) if not back else F.lit(at)
            row = self._levels[hops].where(F.col("node") == wanted).select("node", "parent").first()
            if row is not None:
                back.append(row.node)
                at = row.parent
        rows = [(back[0], back[::-1], len(back) - 1)] if back else []
        return spark.createDataFrame(rows, f"node {kind}, path array<{kind}>, hops int")


class Visited:
    """Nodes that a search has reached, one list of node columns.

    While small they are broadcast. Beyond the limit they go to a table bucketed by node,
    to which each round adds its level: candidates, which their aggregate has already dealt by
    node, meet it without another exchange, and no earlier level is shuffled again.
    """

    def __init__(self, limit: int):
        self._levels: list[DataFrame] = []
        self._bytes, self._limit = 0, limit
        self._table: str | None = None

    def add(self, level: DataFrame, size: int) -> None:
        nodes = level.select("node")
        self._bytes += size
        if self._table is None and self._bytes <= self._limit:
            self._levels.append(nodes)
            return
        fresh = self._table is None
        if fresh:
            self._table = f"visited_{uuid.uuid4().hex}"
            for earlier in self._levels:
                nodes = nodes.union(earlier)
        spark = level.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = nodes.repartition(buckets, "node").write.bucketBy(buckets, "node")
        if fresh:
            writer = writer.option("path", scratch_path(spark, "visited"))
        writer.mode("append").saveAsTable(self._table)

    def new_ones(self, candidates: DataFrame) -> DataFrame:
        """Candidates that are not known.

        An outer join and a null test: the optimizer would push an anti join below the
        aggregate that makes the candidates, and so shuffle all edges.
        """
        if self._table:
            known = candidates.sparkSession.table(self._table).hint("merge")
        else:
            known = self._levels[0]
            for level in self._levels[1:]:
                known = known.union(level)
            known = F.broadcast(known)
        marked = candidates.join(known.select("node", F.lit(True).alias("known")), "node", "left")
        return marked.where("known IS NULL").drop("known")

    def close(self, spark) -> None:
        if self._table:
            spark.sql(f"DROP TABLE IF EXISTS {self._table}")


class EdgeStore:
    """Written edge table with two ways to expand a level of a search.

    A level small enough to broadcast meets the edges where they are read. For
    a larger one the edges are written once more, bucketed by source, so that
    no round has to shuffle them again; edges of hubs, nodes with very many
    edges, stay out of the buckets and meet a broadcast of the hub rows alone.
    """

    def __init__(self, edge_table: DataFrame, hot_rows: int, limit: int):
        pairs = edge_table.select("source", "dest")
        known = pairs.where("source is not null and dest is not null")
        self.edges = materialize(known.distinct(), "edges")
        self._hot_rows, self._limit = hot_rows, limit
        self._parts: tuple[DataFrame, DataFrame, DataFrame] | None = None
        self._table: str | None = None

    def expand(self, level: DataFrame, size: int, strategy: str = "auto") -> DataFrame:
        """``source, dest, rank`` of all edges that leave the nodes of ``level`` (node, rank)."""
        level = level.withColumnRenamed("node", "source")
        if strategy != "shuffle" and size <= self._limit:
            return self.edges.join(F.broadcast(level), "source")
        hubs, hub_edges, bucketed = self._split()
        far = bucketed.join(level.hint("merge"), "source")
        if hubs is None:
            return far
        near = hub_edges.join(F.broadcast(level.join(F.broadcast(hubs), "source", "left_semi")), "source")
        return near.unionByName(far)

    def _split(self):
        if self._parts is None:
            spark = self.edges.sparkSession
            degrees = self.edges.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
            degrees = materialize(degrees, "degrees")
            hubs = materialize(hot_keys(degrees, ["source"], "_n", self._hot_rows), "hubs")
            hub_edges, others = None, self.edges
            if hubs.isEmpty():
                hubs = None
            else:
                hub_edges = materialize(self.edges.join(F.broadcast(hubs), "source", "left_semi"), "hub-edges")
                others = self.edges.join(F.broadcast(hubs), "source", "left_anti")
            path = scratch_path(spark, "bucketed-edges")
            self._table = f"edges_{uuid.uuid4().hex}"
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            # The shuffle first, so that each bucket is one file and not one per task.
            others.repartition(buckets, "source").write.bucketBy(buckets, "source").sortBy("source").option(
                "path", path
            ).saveAsTable(self._table)
            self._parts = hubs, hub_edges, spark.table(self._table)
        return self._parts

    def close(self) -> None:
        """Forget the table name; the files stay in the shared folder."""
        if self._table:
            self.edges.sparkSession.sql(f"DROP TABLE IF EXISTS {self._table}")


def search(
    edge_table: DataFrame,
    start,
    target=None,
    max_hops: int | None = None,
    strategy: str = "auto",
    hot_rows: int = HOT_ROWS,
    limit: int = BROADCAST_BYTES,
    debug_path: str | None = None,
) -> Paths:
    """Breadth-first search from ``start`` over (source, dest) rows.

    Each round joins the newest level with the edges, keeps one row per new
    node, and writes it to the shared folder, which cuts the lineage. What is shuffled of a
    node is itself, its parent and the rank of the parent's path: fixed widths,
    however long the paths are. Stops at ``target``, when nothing new is found, or, if it
    is given, at ``max_hops``.
    """
    spark = edge_table.sparkSession
    store, visited = EdgeStore(edge_table, hot_rows, limit), Visited(limit)
    kind = store.edges.schema["source"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    first = spark.range(0, 1, 1, 1).select(F.lit(start).cast(kind).alias("node"), none.alias("parent"), F.lit(0).cast("bigint").alias("above"))
    levels = [materialize(first, "level")]
    size, found, bound = 0, start == target, None
    try:
        for hop in itertools.count(1):
            if found:
                break
            if max_hops is not None and hop > max_hops:
                bound = max_hops
                break
            visited.add(levels[-1], size)
            fresh = next_level(store, visited, levels[-1], size, strategy, limit)
            is_target = F.lit(False) if target is None else F.col("node") == F.lit(target).cast(kind)
            level = materialize(fresh, "level")
            # One pass tells whether to go on and how to join the next round.
            size, found = level.agg(F.sum(row_bytes(level)), F.max(is_target)).first()
            if size is None:
                break
            levels.append(level)
            if debug_path:
                Paths(levels).parents().write.json(f"{debug_path}/iter-{hop - 1}")
    finally:
        store.close()
        visited.close(spark)
    return Paths(levels, bound)


def ranked(level: DataFrame, small: bool) -> DataFrame:
    """``node, rank``: numbers in the order of the nodes' paths, with gaps."""
    ordered = level.coalesce(1) if small else level.repartitionByRange("above", "node")
    return ordered.sortWithinPartitions("above", "node").select(
        "node", F.monotonically_increasing_id().alias("rank")
    )


def next_level(
    store: EdgeStore, visited: Visited, level: DataFrame, size: int, strategy: str = "auto", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``node, parent, above`` of the nodes first reached from ``level``; of several parents the one with the smallest path."""
    reached = store.expand(ranked(level, size <= limit), size, strategy)
    best = reached.groupBy(F.col("dest").alias("node")).agg(F.min(F.struct("rank", "source")).alias("best"))
    return visited.new_ones(best).select("node", F.col("best.source").alias("parent"), F.col("best.rank").alias("above"))


def path_lines(found: Paths, start, target) -> DataFrame:
    """The path as one node per row in order, or one row that says there is none.

    After a search that stopped at its bound that can be said of short paths only.
    """
    row = found.path_to(target)
    if row.isEmpty():
        # Fixed value: the text of the message.
        text = f"no path exists from node {start} to node {target}!"
        if found.bound is not None:
            text = f"no path of at most {found.bound} edges exists from node {start} to node {target}!"
        return row.sparkSession.range(1).select(F.lit(0).alias("step"), F.lit(text).alias("line"))
    steps = row.select(F.posexplode("path").alias("step", "line"))
    return steps.select("step", F.col("line").cast("string").alias("line")).orderBy("step")
