import math
import re
from collections import Counter

import numpy as np
import pytest

from quernel.llm import search
from quernel.llm.common import documents
from quernel.sources import load_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UP))


def brute(docs, items, kept=10):
    """Sorted (item_id, rank, doc_id, score) as text; ``docs`` and ``items`` are (id, text) lists."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n) // length
            score = 0
            for term in terms(text):
                if term in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((10**9 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(str(item), rank, str(s[3]), -s[0]) for rank, s in enumerate(sorted(scored)[:kept], 1)]
    return sorted(out)


def found(docs, items, **settings):
    return sorted((str(r.item_id), r.rank, str(r.doc_id), r.score) for r in search.search(docs, items, **settings).collect())


@pytest.fixture
def pairs():
    def of(df, key):
        return [(r[key], r.text) for r in df.collect()]

    return of


@pytest.mark.parametrize("query_bytes", [1 << 20, 1500])
def test_given_tables(spark, small, pairs, query_bytes):
    docs, items = documents(spark, small), load_table(spark, "benchmark", folder=small)
    assert found(docs, items, query_bytes=query_bytes) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_windows_shards_and_ties(spark):
    """Several windows of a shard, several shards of a task, and many equal scores."""
    rng = np.random.default_rng(5)
    names = [f"t{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    rows = [(int(i), " ".join(rng.choice(names, rng.integers(1, 12), p=share / share.sum()))) for i in rng.permutation(5000)]
    rows += [(6000 + i, "t1 t2 t40") for i in range(200)] + [(None, "t1 t2 t40"), (3, "t1 t2 t40")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    texts = ["t0 t1", "t1 t2 t40 t40", "t59", "t3 t50 t20 T0 zz", "nothing here", " ".join(names)]
    items = list(enumerate(texts))
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute(rows, items)
    assert found(docs, asked) == expected
    assert found(docs, asked, kept=250) == brute(rows, items, 250)
    # Some forty shards, one after the other, instead of one.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        assert found(docs, asked, postings=300) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_skipping_is_used_and_loses_nothing():
    """Later windows are skipped once the kept scores pass their bounds."""
    rng = np.random.default_rng(2)
    n = 20_000
    hits = [[50] if i < 20 else [1] for i in range(n)]
    batch = search.pa.record_batch(
        {
            "doc_id": search.pa.array(range(n)),
            "n": search.pa.array(rng.integers(50, 60, n)),
            "terms": search.pa.array([[0]] * n, search.pa.list_(search.pa.int32())),
            "hits": search.pa.array(hits, search.pa.list_(search.pa.int64())),
        }
    )
    shard = search.Shard([batch], search.Corpus(n, 55 * n, {}))
    walked = []
    inner = shard._window
    shard._window = lambda w, *rest: (walked.append(w), inner(w, *rest))
    best = search.Best(10)
    shard.rank([(0, 7)], best)
    assert walked == [0] and len(shard.edges) == 21
    order = np.lexsort((shard.docs, -shard.gains))[:10]
    assert [r[0] for r in best.rows] == (shard.gains[order] * 7).tolist()
    assert [r[1] for r in best.rows] == shard.docs[order].tolist()


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "-- !"), (4, "Émile émile A1"), (5, "a1 " * 40_000), (5, "A1 b"), (None, "a1 b"), (6, "ÉMILE")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, rank int, item_id string")
    items = [(1, "A1"), (1, "A1"), (None, "b émile"), (2, ""), (3, None), (4, "zz"), (5, "--")]
    asked = spark.createDataFrame([(*r, 2) for r in items], "item_id bigint, text string, doc_id int")
    assert found(docs, asked) == brute(rows, items)
    assert found(docs.limit(0), asked) == [] and found(docs, asked.limit(0)) == []
    assert found(docs, asked.filter("item_id = 5")) == [] and found(docs, asked.filter("item_id = 3")) == []
    names = docs.selectExpr("CAST(doc_id AS string) AS doc_id", "text")
    assert found(names, asked) == brute([(None if i is None else str(i), t) for i, t in rows], items)
