import pytest

from quernel.llm import line_dedup

LONG = "a line that is long enough {}"


def kept(df, **settings):
    return sorted(
        ((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df, **settings).collect()),
        key=lambda r: (r[0] is not None, r),
    )


@pytest.mark.parametrize("hot", [0.001, 0.9])
def test_copies_stay_in_the_last_document(spark, monkeypatch, hot):
    """By the broadcast of frequent lines, and by the sorted ranges."""
    found = line_dedup.dropped_lines
    monkeypatch.setattr(line_dedup, "dropped_lines", lambda f: found(f, hot))
    a, b, c = (LONG.format(x) for x in "abc")
    rows = [
        (1, f"{a}\nown\n{b}"), (2, f"  {a.upper()}\t\n{c}\n{a}"), (3, f"{b}\n{a}\n{a}"), (4, f"x\n{c}\n\n{b}\n"),
        (5, None), (6, ""), (7, "short\nshort"), (8, "short"), (9, "short"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS kept", "1 AS n_lines")
    assert kept(df) == [
        (1, 3, 2, "own"), (2, 3, 2, c), (3, 3, 1, f"{a}\n{a}"), (4, 5, 0, f"x\n{c}\n\n{b}\n"),
        (5, 1, 0, ""), (6, 1, 0, ""), (7, 2, 0, "short\nshort"), (8, 1, 0, "short"), (9, 1, 0, "short"),
    ]


def test_repeated_and_missing_ids(spark):
    a = LONG.format("a")
    rows = [(1, a), (1, a), (1, f"{a}\nother"), (None, a), (None, f"y\n{a}"), (2, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    # Ids 1 and 2 and the rows without an id are three documents.
    assert [r[3] for r in kept(df)] == ["", "y", "", "", "other", a]
    assert kept(df.limit(0)) == []


def test_a_very_long_text(spark):
    a = LONG.format("a")
    rows = [(1, "\n".join([a, "z"] * 20000)), (2, a), (3, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert kept(df) == [(1, 40000, 20000, "\n".join(["z"] * 20000)), (2, 1, 1, ""), (3, 1, 0, a)]


def test_bitmaps_are_runs(spark):
    rows = [(1, 0, p) for p in (0, 1, 2, 7, 9, 10)]
    got = line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id bigint, text_hash int, pos int")).first()
    assert got.n_dropped == 6 and [tuple(z) for z in got.zeros] == [(0, 3), (7, 1), (9, 2)]
