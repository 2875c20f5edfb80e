import random

import brute
import numpy as np
import pytest

from quernel.llm import hashing, near_dup
from quernel.llm.common import documents


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_as_brute_force(spark, folder):
    docs = documents(spark, folder)
    expected = brute.near_duplicates({r.doc_id: r.text for r in docs.collect()})
    assert found(docs) == expected


def test_a_large_group_of_near_copies(spark):
    """Copies with random edits: many buckets hold members that aren't linked with their leader."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(999)}" for _ in range(120)]
    docs = {}
    for i in range(150):
        copy = list(base)
        for _ in range(draw.randrange(6)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(999)}"
        docs[i] = " ".join(copy)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    assert found(df) == brute.near_duplicates(docs)


@pytest.mark.parametrize("bound", [80, 95])
def test_other_bounds(spark, bound):
    docs = documents(spark, "/root/testdata/sf0.01")
    expected = brute.near_duplicates({r.doc_id: r.text for r in docs.collect()}, bound)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs, bound).collect()}
    assert got == expected


def test_edges(spark):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "a b", "x"), (4, "A  b\n", "y"), (5, "a b c", None), (6, " \t\n ", "x"),
        (7, "a b c d e f g", "x"), (7, "a b c d e f g", "x"), (None, "a b c d e f g", "x"), (8, "a b c d e f g h", "x"),
        (9, "z " * 30000, "x"), (10, "z " * 29000, "x"), (11, "É b c d e", "x"), (12, "é b c d e", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles string")
    got = {}
    for r in near_dup.near_duplicates(df).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert got.pop(7) == [(3, 7, True)] * 2
    assert got.pop(None) == [(3, None, True)]
    assert {k: v[0] for k, v in got.items()} == {
        1: (0, 1, True), 2: (0, 2, True), 3: (1, 3, True), 4: (1, 3, False), 5: (1, 5, True), 6: (0, 6, True),
        8: (4, 8, True), 9: (1, 9, True), 10: (1, 9, False), 11: (1, 11, True), 12: (1, 12, True),
    }
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_words_do_not_depend_on_segments(monkeypatch):
    draw = np.random.default_rng(3)
    texts = ["".join(draw.choice(list("abC \n\té"), n)) for n in (0, 1, 50, 3000, 7, 0, 20000)]
    texts.append("q" * 5000)

    def each(size):
        monkeypatch.setattr(hashing, "SEGMENT", size)
        import pyarrow as pa

        return [list(w) for w in hashing.batch_words(pa.array(texts))]

    assert each(64) == each(1 << 19)
    assert [len(w) for w in each(1 << 19)] == [len(brute.words(t)) for t in texts]


def test_estimate_is_near_the_truth():
    draw = np.random.default_rng(9)
    a = np.unique(draw.integers(0, 2**62, 3000).astype(np.uint64))
    for share in (0.3, 0.6, 0.9):
        n = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.r_[a[:n], draw.integers(2**62, 2**63, len(a) - n).astype(np.uint64)])
        regs = [near_dup.registers(x)[None, :] for x in (a, b)]
        j, deviation = near_dup.estimate(*regs, np.array([len(a)]), np.array([len(b)]))
        assert abs(j[0] - share) < 4 * max(deviation[0], 0.04)
