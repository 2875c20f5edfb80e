"""Adjacency edges and shortest paths on a graph derived from parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.operators import graph
from quernel.plans.tables import table


def adjacency(spark, folder):
    """Each part p points to 2p+1, 2p+2 and (7p+3) mod the number of parts."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("p"))
    size = F.lit(part.count())
    line = F.format_string(
        "%d: %d %d  %d", F.col("p"), F.col("p") * 2 + 1, F.col("p") * 2 + 2, (F.col("p") * 7 + 3) % size
    )
    lines = part.select(line.alias("value"))
    pair = F.split("value", ":")
    return lines.select(F.get(pair, F.lit(0)).alias("source"), F.get(pair, F.lit(1)).alias("dest"))


def adjacency_edges(spark, folder):
    return graph.edges(adjacency(spark, folder))


def _numbered(spark, folder):
    each = graph.edges(adjacency(spark, folder))
    return each.select(F.col("source").cast("bigint"), F.col("dest").cast("bigint"))


def shortest_hops(spark, folder):
    return graph.search(_numbered(spark, folder), 0).hops()


def shortest_paths(spark, folder):
    found = graph.search(_numbered(spark, folder), 0).paths()
    return found.select("node", F.concat_ws(",", F.col("path").cast("array<string>")).alias("path"), "hops")


def shortest_path(spark, folder):
    """Path from the first node to the last part, one node per row."""
    last = table(spark, folder, "part").agg(F.max("p_partkey")).first()[0]
    found = graph.search(_numbered(spark, folder), 0, target=last)
    return graph.path_lines(found, 0, last)


QUERIES = {
    "adjacency_edges": adjacency_edges,
    "shortest_hops": shortest_hops,
    "shortest_paths": shortest_paths,
    "shortest_path": shortest_path,
}

_EDGES = """
edges AS (
  SELECT p_partkey AS source, unnest([2 * p_partkey + 1, 2 * p_partkey + 2,
         (7 * p_partkey + 3) % (SELECT count(*) FROM part)]) AS dest
  FROM part)
"""

# One row per node, level by level; of a node's shortest paths the smallest.
_BEST = f"""
WITH RECURSIVE {_EDGES},
best(node, path) USING KEY (node) AS (
  SELECT CAST(0 AS BIGINT), [CAST(0 AS BIGINT)]
  UNION
  SELECT dest, min(list_append(path, dest)) FROM best JOIN edges ON node = source
  WHERE NOT EXISTS (FROM recurring.best AS known WHERE known.node = dest) GROUP BY dest)
"""

ORACLES = {
    "adjacency_edges": f"""
WITH {_EDGES} SELECT CAST(source AS VARCHAR) AS source, CAST(dest AS VARCHAR) AS dest FROM edges
""",
    "shortest_hops": _BEST + "SELECT node, CAST(len(path) - 1 AS INTEGER) AS hops FROM best",
    "shortest_paths": _BEST
    + "SELECT node, array_to_string(path, ',') AS path, CAST(len(path) - 1 AS INTEGER) AS hops FROM best",
    "shortest_path": _BEST
    + """
SELECT CAST(i - 1 AS INTEGER) AS step, CAST(path[i] AS VARCHAR) AS line
FROM (SELECT path, unnest(range(1, len(path) + 1)) AS i
      FROM best WHERE node = (SELECT max(p_partkey) FROM part))
""",
}
