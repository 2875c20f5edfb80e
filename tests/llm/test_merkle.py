import hashlib

import pytest
from pyspark.sql import functions as F

from quernel.llm import merkle
from quernel.llm.common import documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    out = ""
    for name in merkle.FIELDS:
        value = row[name]
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def tree(nodes, arity):
    """(top, [siblings of each node, level by level])."""
    proofs, holders = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for i in run:
                for k in holders[i]:
                    proofs[k].append(("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i)))
        holders = [[k for i in run for k in holders[i]] for run in runs]
        nodes = [h(*(nodes[i] for i in run)) for run in runs]
    return nodes[0], proofs


def brute(rows, arity=2):
    """Sorted (doc_id, leaf, subroot, root, proof) of row dictionaries."""
    def first(x):
        return (x is not None, x if x is not None else 0)

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    tops, below = [], []
    for lang in langs:
        mine = sorted(((first(r["doc_id"]), leaf(r), r["doc_id"]) for r in rows if r["lang"] == lang))
        top, proofs = tree([m[1] for m in mine], arity)
        tops.append(top)
        below.append([(m[2], m[1], top, p) for m, p in zip(mine, proofs)])
    if not tops:
        return []
    root, over = tree(tops, arity)
    return sorted((str(i), x, top, root, tuple(p + o)) for part, o in zip(below, over) for i, x, top, p in part)


def found(docs, **settings):
    rows = merkle.verified(merkle.manifest(docs, **settings), F.col("leaf")).collect()
    assert all(r.verified for r in rows)
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.steps)) for r in rows)


@pytest.mark.parametrize("arity,block,group", [(2, 1024, 16), (2, 2, 2), (2, 4, 8), (3, 3, 9), (5, 30, 5)])
def test_blocks_and_exchanges_give_the_tree(spark, arity, block, group):
    rows = [
        {"doc_id": i, "text": f"text {i}", "lang": "en" if i < 83 else f"l{i % 23}", "source": "s", "n_chars": i}
        for i in range(131)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert found(docs, arity=arity, block=block, group=group) == brute(rows, arity)


def test_given_documents(spark, small):
    docs = documents(spark, small)
    assert found(docs, block=8, group=4) == brute([r.asDict() for r in docs.collect()])


def test_edges(spark):
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, place int, STEPS int"
    values = [
        (None, None, None, None, None), (None, "", None, "", 0), (1, "é" * 50000, "ß", "s", 5), (1, "a", "ß", "s", 5),
        (2, "a", "z", "s", 5), (2, "a", "z", "s", 5), (3, "a", "", "-", 5), (4, "x\ny", "ab", None, -1),
    ]
    docs = spark.createDataFrame([(*v, "n", 1, 2) for v in values], kinds)
    rows = [dict(zip(merkle.FIELDS, (v[0], v[3], v[2], v[4], v[1]))) for v in values]
    for block, group in ((1024, 16), (2, 2)):
        assert found(docs, block=block, group=group) == brute(rows)
    assert found(docs.limit(0)) == []
    one = found(docs.filter("doc_id = 4"))
    assert one[0][1] == one[0][2] == one[0][3] and one[0][4] == ()
    with pytest.raises(ValueError):
        merkle.manifest(docs, arity=1)


def test_a_changed_row_is_found(spark, small):
    docs = documents(spark, small)
    changed = merkle.leaf_of(docs, changed={"text": F.when(docs["doc_id"] == 7, "other").otherwise(docs["text"])})
    rows = merkle.verified(merkle.manifest(docs, extra={"now": changed}), F.col("now"))
    assert [r.doc_id for r in rows.filter("NOT verified").collect()] == [7]
