import brute
import numpy as np
import pytest

from quernel.llm import lm
from quernel.llm.common import documents


def found(df):
    return {
        r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        for r in lm.score(df).collect()
    }


@pytest.mark.parametrize("range_tokens", [3_000_000, 5000])
def test_as_brute_force(spark, small, monkeypatch, range_tokens):
    """Also with so many ranges that frequent words are cut."""
    monkeypatch.setattr(lm, "RANGE_TOKENS", range_tokens)
    docs = documents(spark, small)
    expected, got = brute.lm_scores({r.doc_id: r.text for r in docs.collect()}), found(docs)
    assert got.keys() == expected.keys()
    for i, row in expected.items():
        assert got[i][:4] == row[:4]
        assert np.allclose(got[i][4:], row[4:], rtol=1e-9)


def test_held_out_text_is_more_likely_than_by_single_words(spark):
    rows = [r for r in found(documents(spark, "/root/testdata/sf0.01")).values() if r[0]]
    assert sum(r[5] for r in rows) > sum(r[4] for r in rows)


def test_probabilities_sum_to_one():
    model = brute.KneserNey(["a b a b c", "a c d", "b b a"])
    for v in ("", "a", "b", "c", "never"):
        assert abs(sum(model.p(v, w) for w in [*model.words, "unknown"]) - 1) < 1e-12


def test_edges(spark):
    texts = {1: None, 2: "", 3: "a b", 4: "A  b\n", 5: "b " * 50000, 6: "new", 7: " \t"}
    rows = [(i, t, "x") for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    expected = brute.lm_scores(texts)
    got = found(df)
    for i, row in expected.items():
        assert got[i][:4] == row[:4] and np.allclose(got[i][4:], row[4:])
    assert lm.score(df.limit(0)).count() == 0
    none = spark.createDataFrame([(None, None)] * 2, "doc_id bigint, text string")
    assert [r.n_tokens for r in lm.score(none).collect()] == [1, 1]
    held = next(i for i in range(99) if brute.lm_scores({i: "a"})[i][0])
    alone = spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")
    assert found(alone)[held][:4] == (True, 3, 0, 0)
