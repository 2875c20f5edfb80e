import pytest
from conftest import rows
from pyspark.sql import functions as F

from quernel.operators import graph

TEXT = [("1", " 2 3"), ("2", " 4"), ("3", "4 "), ("4", " 1  5"), ("6", None), ("7", "")]


@pytest.fixture
def edges(spark):
    each = graph.edges(spark.createDataFrame(TEXT, "source string, dest string"))
    return each.select(F.col("source").cast("bigint"), F.col("dest").cast("bigint"))


def test_edges(edges):
    assert rows(edges) == [(1, 2), (1, 3), (2, 4), (3, 4), (4, 1), (4, 5)]


def lines(found, start, target):
    return [r.line for r in graph.path_lines(found, start, target).collect()]


@pytest.mark.parametrize("hot_rows,limit", [(10**6, 1 << 26), (10**6, 0), (1, 0)])
def test_paths(edges, hot_rows, limit):
    found = graph.search(edges, 1, hot_rows=hot_rows, limit=limit)
    assert rows(found.hops()) == [(1, 0), (2, 1), (3, 1), (4, 2), (5, 3)]
    assert lines(found, 1, 5) == ["1", "2", "4", "5"]
    assert lines(found, 1, 1) == ["1"]
    assert lines(found, 1, 6) == ["no path exists from node 1 to node 6!"]
    parents = {r.node: (r.source, r.distance) for r in found.parents().collect()}
    assert parents == {1: (None, 0), 2: (1, 1), 3: (1, 1), 4: (2, 2), 5: (4, 3)}


def test_search_stops_at_the_target_and_at_the_limit(spark, edges):
    assert rows(graph.search(edges, 1, target=4).hops()) == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert rows(graph.search(edges, 1, target=1).hops()) == [(1, 0)]
    chain = spark.range(20).select(F.col("id").alias("source"), (F.col("id") + 1).alias("dest"))
    found = graph.search(chain, 0, max_hops=6)
    assert max(r.hops for r in found.hops().collect()) == 6
    assert lines(found, 0, 7) == ["no path of at most 6 edges exists from node 0 to node 7!"]
    assert lines(found, 0, 6)[-1] == "6"


def test_search_without_a_bound_goes_on_to_the_end(spark):
    chain = spark.range(20).select(F.col("id").alias("source"), (F.col("id") + 1).alias("dest"))
    found = graph.search(chain, 0, target=20)
    assert lines(found, 0, 20) == [str(i) for i in range(21)]
    assert lines(graph.search(chain, 0), 0, 99) == ["no path exists from node 0 to node 99!"]


def test_text_nodes(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "c")], "source string, dest string")
    assert lines(graph.search(edges, "a", "c"), "a", "c") == ["a", "b", "c"]


def test_hub_agrees_with_networks_without_split(spark):
    """Node 0 holds a third of all edges."""
    hub = spark.range(1, 301).select(F.lit(0).cast("bigint").alias("source"), F.col("id").alias("dest"))
    rest = spark.range(600).select((F.col("id") % 300 + 1).alias("source"), (F.col("id") * 7 % 900).alias("dest"))
    edges = hub.union(rest)
    plain = rows(graph.search(edges, 1, max_hops=3).paths())
    assert (300, [1, 300], 1) in plain and (7, [1, 0, 7], 2) in plain
    assert plain == rows(graph.search(edges, 1, max_hops=3, hot_rows=10, limit=0).paths())
    assert plain == rows(graph.search(edges, 1, max_hops=3, strategy="shuffle", hot_rows=50).paths())


def test_large_levels_join_buckets_without_shuffling_the_edges(spark):
    from conftest import plan_of

    edges = spark.range(500).select((F.col("id") % 50).alias("source"), F.col("id").alias("dest"))
    store = graph.EdgeStore(edges, 10**6, 0)
    level = spark.range(5).select(F.col("id").alias("node"), F.col("id").alias("rank"))
    out = store.expand(level, 10**9)
    plan = plan_of(out, "simple")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    assert out.count() == 50
    store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edges_")]


def layered(spark, layers=6, width=40):
    """Every node of a layer leads to several of the next, so paths of equal length compete."""
    each = spark.range(layers * width).select((F.col("id") % width).alias("i"), F.floor(F.col("id") / width).alias("k"))
    ends = F.explode(F.array(*[(F.col("i") * m + m) % width for m in (3, 5, 7, 11)])).alias("j")
    return each.select("i", "k", ends).select(
        # Numbers fall with the layer, so that the order of nodes is not that of layers.
        (F.col("i") * 100 + 50 - F.col("k")).cast("bigint").alias("source"),
        (F.col("j") * 100 + 49 - F.col("k")).cast("bigint").alias("dest"),
    )


def brute_paths(pairs, start):
    best, level = {start: [start]}, [start]
    while level:
        found = {}
        for a, b in pairs:
            if a in level and b not in best:
                found[b] = min(found.get(b, best[a] + [b]), best[a] + [b])
        best |= found
        level = list(found)
    return best


@pytest.mark.parametrize("limit", [1 << 26, 3000, 0])
def test_smallest_of_the_shortest_paths(spark, monkeypatch, limit):
    monkeypatch.setattr(graph, "CHAIN", 3)
    edges = layered(spark).union(spark.createDataFrame([(949, 50), (2049, 1150), (44, 50)], "source bigint, dest bigint"))
    expected = brute_paths([tuple(r) for r in edges.distinct().collect()], 50)
    assert len(expected) > 90
    found = graph.search(edges, 50, limit=limit)
    assert {r.node: r.path for r in found.paths().collect()} == expected
    assert {r.node: r.hops for r in found.hops().collect()} == {n: len(p) - 1 for n, p in expected.items()}
    far = max(expected, key=lambda n: (len(expected[n]), n))
    assert found.path_to(far).first().path == expected[far]
    assert found.path_to(50).first().path == [50] and found.path_to(-1).first() is None


def test_a_late_round_shuffles_no_earlier_level(spark):
    from conftest import plan_of

    edges = layered(spark)
    store, visited = graph.EdgeStore(edges, 10**6, 0), graph.Visited(0)
    level = spark.createDataFrame([(50, None, 0)], "node bigint, parent bigint, above bigint")
    for _ in range(4):
        visited.add(level, 1)
        level = graph.materialize(graph.next_level(store, visited, level, 1, limit=0), "level")
    visited.add(level, 1)
    plan = plan_of(graph.next_level(store, visited, level, 1, limit=0), "simple")
    # The level by rank, then by node to the edges, and the candidates by node: nothing else moves.
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Bucketed: true") == 2
    assert "path" not in plan.split("ReadSchema")[-1]
    store.close(), visited.close(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("edges_", "visited_"))]
