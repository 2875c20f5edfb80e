import random

import brute
import pytest

from quernel.llm import mixing
from quernel.llm.common import documents


def mixed(df, **settings):
    return {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in mixing.mix(df, **settings).collect()}


@pytest.mark.parametrize("block_rows", [50_000, 80, 20])
def test_as_brute_force(spark, small, block_rows):
    docs = documents(spark, small)
    expected = brute.mix({r.doc_id: (r.text, r.source) for r in docs.collect()})
    got = mixed(docs, block_rows=block_rows)
    # The same documents, however many blocks there are.
    assert got == expected
    for source in {r[1:3] for r in got.values()}:
        rows = [r for r in got.values() if r[1:3] == source]
        # The queue stops at a document's end, and the budget that others leave goes on to the next ones.
        assert abs(sum(r[3] for r in rows) - source[1]) <= 2 * max(r[0] for r in got.values())
    assert all(r[3] in (0, r[0], 2 * r[0], 3 * r[0]) for r in got.values())
    assert mixed(docs, block_rows=block_rows) == got


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 5, 50, 1000, 10**13]) for s in ["é", "b", "a", "Z", None, "z", "zz", "", "c"]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    expected = {s: float(t) for s, t in brute.targets(sizes).items()}
    assert got == pytest.approx(expected, rel=1e-15)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y z", None), (4, "x", "a"), (4, "x", "a"), (None, "w " * 50000, "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert sorted(r.size for r in got) == [0, 0, 1, 1, 3, 50000]
    assert sum(r.taken for r in got) <= 50005 and all(r.taken <= 3 * r.size for r in got)
    copies = mixing.mixed_rows(df).collect()
    assert len(copies) == sum(r.copies for r in got) and set(df.columns) == set(copies[0].asDict())
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_rows(df.limit(0)).count() == 0
    silent = df.filter("doc_id < 3")
    assert [r.taken for r in mixing.mix(silent).collect()] == [0, 0] and mixing.mixed_rows(silent).count() == 0


def test_clashing_names_and_text_ids(spark):
    """Columns named as the working ones, also in capitals, come through; ids may be text."""
    odd = ["mix_id", "mix_copies", "MIX_COPY", "_copies", "_place", "__id", "gone_id", "Rows", "_FROM"]
    kinds = ", ".join(f"{c} int" for c in odd)
    rows = [(f"k{i}", "w " * (i % 9 + 1), "ab"[i % 2], *range(len(odd))) for i in range(40)] * 2
    df = spark.createDataFrame(rows, f"doc_id string, text string, source string, {kinds}")
    got = mixing.mixed_rows(df).collect()
    taken = sum(r.copies for r in mixing.mix(df).collect())
    assert mixing.mixed_rows(df).columns == df.columns and len(got) == taken
    assert all(list(r)[3:] == list(range(len(odd))) for r in got)


def test_equal_rows_of_different_sources(spark):
    """Copies belong to the source that they were taken for, and reruns agree."""
    rows = [(None, "a b c", s, n) for s in ("x", "y") for n in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n int")
    taken = {}
    for r in mixing.mix(df).collect():
        taken[r.source] = taken.get(r.source, 0) + r.copies
    runs = [sorted((r.source, r.n) for r in mixing.mixed_rows(df.repartition(k)).collect()) for k in (1, 5)]
    assert runs[0] == runs[1]
    assert {s: sum(r[0] == s for r in runs[0]) for s in taken} == taken
