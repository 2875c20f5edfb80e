import math

import brute
import duckdb
import numpy as np
from pyspark.sql import functions as F

from quernel.llm import quality
from quernel.llm.queries import ORACLES


def repeated(words):
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 5)})


def test_measures(spark):
    draw = np.random.default_rng(1)
    texts = [None, "", " \t\n", "a", "x " * 9, "x " * 30000, "É é\x0bÉ", "# a\n\n# a\n#", "a!! b|c\na!! b|c"]
    texts += [" ".join(draw.choice(list("abc"), n)) for n in range(60)]
    df = spark.createDataFrame([(i, t, "en", 5) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, n_words int")
    for r in quality.measures(df).collect():
        t = texts[r.doc_id] or ""
        w = brute.words(t, lower=False)
        lines = [x for x in t.split("\n") if brute.WORD.search(x)]
        rep = repeated(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep,
        )
        assert r.base_failed == (len(w) < 10 or 100 * rep > 20 * len(w))
    assert quality.measures(df.limit(0)).count() == 0


def test_binomial_tail(spark):
    cases = [(0, 0), (1, 0), (10, 0), (500, 0), (500, 3), (5000, 20), (5000, 49), (400000, 3900), (10**9, 9_990_000)]
    df = spark.createDataFrame(cases, "n bigint, k bigint")
    got = {(r.n, r.k): r.p for r in df.select("*", quality.at_most_risk(F.col("n"), F.col("k"), 0.01).alias("p")).collect()}
    for n, k in cases[:7]:
        exact = sum(math.comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1)) if n else 1.0
        assert math.isclose(got[n, k], exact, rel_tol=1e-8)
    for n, k in cases[7:]:  # by the normal distribution, which is near here
        z = (k + 0.5 - 0.01 * n) / math.sqrt(0.0099 * n)
        assert math.isclose(got[n, k], math.erfc(-z / math.sqrt(2)) / 2, rel_tol=0.02)


def test_thresholds_keep_their_promise(spark):
    """Bad documents have many symbols; rules that would cost good ones stay off."""
    rows, labels = [], []
    for i in range(4000):
        bad = i % 10 == 0
        text = " ".join(f"w{i}x{k}" + ("$" if bad else "") for k in range(20)) + (" !!" if i % 3 == 0 else "")
        rows.append((i, text, ["en", None][i % 2]))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels + [(None, 0), (5, None), (99999, 1)], "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in quality.judge(docs, marks).collect()}
    assert all(kept[i] for i in range(4000) if i % 10) and not any(kept[i] for i in range(0, 4000, 20))
    # Without enough labels nothing is proved, and nothing is rejected.
    few = quality.judge(docs, marks.limit(50)).collect()
    assert all(r.kept for r in few)
    none = quality.judge(docs, marks.limit(0)).collect()
    assert all(r.kept for r in none)
    assert quality.judge(docs.limit(0), marks).count() == 0


def labelled():
    """Documents in four languages, each with bad ones that another rule tells, and their labels."""

    def text(lang, i, bad):
        w = [f"w{i}x{k}" for k in range(60 if lang == "es" else 20)]
        if lang == "en":
            w = [x + "#" * (k < (12 if bad else 4 * (i % 2))) for k, x in enumerate(w)]
        elif lang == "de":
            w = [x + "!" * (k < (7 if bad else 2)) for k, x in enumerate(w)]
        elif lang == "fr" and bad:
            return "\n".join(" ".join(w[k : k + 4]) + "\nsame" for k in range(0, 16, 4))
        elif lang == "es" and bad:
            w[40:45] = w[5:10]
        return " ".join(w)

    docs, labels = [], []
    for lang in ("en", "de", "fr", "es"):
        for i in range(700):
            docs.append((len(docs), text(lang, i, i >= 640), lang))
            labels.append((docs[-1][0], int(i < 640)))
    # Not labelled, and judged all the same.
    docs += [(10_000 + k, text(lang, 5, True), lang) for k, lang in enumerate(("en", "de", "fr", "es", None))]
    return docs, labels


def test_rules_in_force_in_each_language(spark):
    """Known thresholds, and the same verdicts from SQL where the method rejects documents."""
    rows, marks = labelled()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    chosen = quality.thresholds(quality.measures(docs), labels).collect()
    assert {(r.stratum, r.rule, r.cutoff, r.n_good, r.rejected_good, r.rejected_bad) for r in chosen} == {
        ("en", "n_symbols", 50, 640, 0, 60), ("de", "n_marks", 30, 640, 0, 60),
        ("fr", "n_dup_lines", 10, 640, 0, 60), ("es", "n_repeat_words", 15, 640, 0, 60),
    }
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(docs, labels).collect()}
    assert [got[10_000 + k] for k in range(5)] == [(False, False)] * 4 + [(False, True)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    db.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER)")
    tables = docs.toPandas(), labels.toPandas()
    db.register("d", tables[0])
    db.register("l", tables[1])
    db.execute("INSERT INTO documents SELECT * FROM d")
    db.execute("INSERT INTO labels SELECT * FROM l")
    sql = db.execute(f"SELECT doc_id, base_failed, kept FROM ({ORACLES['op4_quality_rules']})").fetchall()
    assert {i: (failed, kept) for i, failed, kept in sql} == got
    # Too few labels for any proof: no sequence counts, and none is in force.
    db.execute("DELETE FROM labels WHERE doc_id % 700 < 500")
    sql = db.execute(f"SELECT base_failed, kept FROM ({ORACLES['op4_quality_rules']})").fetchall()
    assert all(kept != failed for failed, kept in sql)


def test_the_level_goes_to_sequences_and_not_to_cutoffs(spark):
    """450 good documents without a rejection are a proof over four sequences of 16 cutoffs, 400 are not."""
    rows, marks = labelled()
    en = [r for r in rows if r[2] == "en" and (r[0] < 450 or 640 <= r[0] < 700)]
    docs = spark.createDataFrame(en, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    measured = quality.measures(docs)
    # 450 good ones: 0.99^450 = 0.0109 lies below 0.05 / 4 and above 0.05 / (4 * 16).
    assert [(r.rule, r.cutoff) for r in quality.thresholds(measured, labels).collect()] == [("n_symbols", 50)]
    fewer = measured.filter("doc_id < 400 OR doc_id >= 640")
    assert quality.thresholds(fewer, labels).count() == 0
