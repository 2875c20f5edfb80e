import random
from collections import defaultdict

from quernel.llm import sharding


def linear(sizes, capacity):
    rooms, out = [], []
    for size in sizes:
        fits = [(room, b) for b, room in enumerate(rooms) if room >= size]
        b = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[b] -= size
        out.append(b)
    return out


def test_tree_packs_like_a_search_of_all_bins():
    draw = random.Random(1)
    for _ in range(30):
        sizes = sorted((draw.randint(1, 60) for _ in range(200)), reverse=True)
        assert sharding.best_fit_decreasing(sizes, 100) == linear(sizes, 100)


def test_tree_stays_balanced():
    tree = sharding.CapacityTree()
    for i in range(1000):
        tree.add((i, i))
    for i in range(0, 1000, 2):
        assert tree.take_at_least(i) == (i, i)
    assert tree.root.height <= 13 and tree.take_at_least(1000) is None


def test_pack_is_near_equal():
    draw = random.Random(2)
    sizes = sorted((int(draw.paretovariate(1.2)) for _ in range(3000)), reverse=True)
    loads = defaultdict(int)
    for size, b in zip(sizes, sharding.pack(sizes, 8)):
        loads[b] += size
    assert len(loads) == 8 and max(loads.values()) <= max(sizes[0], sum(sizes) / 8 + 1)
    assert sharding.pack([], 8) == [] and sharding.pack([5], 8) == [0]


def shards(df, **settings):
    return sharding.shard(df, **settings).collect()


def test_groups_slots_and_sizes(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice(["same", "t" * draw.randint(0, 3000), None, f"text {i}"]), 0) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard int")
    got = shards(df)
    texts, places, slots, loads = dict(r[:2] for r in rows), defaultdict(set), defaultdict(list), defaultdict(int)
    for r in got:
        assert r.size == len(texts[r.doc_id] or "") + 1 and r.grown_shard is None and r.law == "bytes"
        places[texts[r.doc_id] or ""].add(r.shard)
        slots[r.shard].append((r.slot, r.doc_id))
        loads[r.shard] += r.size
    assert len(got) == 600 and all(len(p) == 1 for p in places.values())
    assert all([s for s, _ in sorted(x)] == list(range(len(x))) for x in slots.values())
    assert all([d for _, d in sorted(x)] == sorted(d for _, d in x) for x in slots.values())
    assert max(loads.values()) - min(loads.values()) < 0.01 * sum(loads.values())


def test_a_group_above_a_shard_is_cut(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "IF(id < 500, 'the same', string(id)) AS text")
    loads = defaultdict(int)
    for r in shards(df):
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())


def test_edges(spark):
    odd = spark.createDataFrame([(None, None), (None, None), (1, ""), (1, "")], "doc_id bigint, text string")
    got = shards(odd)
    assert [r.size for r in got] == [1] * 4 and len({(r.shard, r.slot) for r in got}) == 4
    assert shards(odd.limit(0)) == []
