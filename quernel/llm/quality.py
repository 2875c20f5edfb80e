"""Quality rules with risk-controlled thresholds.

A rule rejects a document when 100 * measure > cutoff * n_words. Its cutoff is
chosen per stratum from a fixed list, on labelled documents: a cutoff may be used
only if an exact binomial test shows, at the corrected level, that it
rejects at most ``risk`` of the good documents of the stratum. The cutoffs of a rule
are nested: a stricter one rejects whatever a looser one does, so its p-value is no smaller.
They are tested in that fixed order, from loose to strict, up to the first that fails, and such a
sequence needs no correction for its length. The level is divided by the number of sequences, one for each
rule and stratum. Only those count that have enough good documents for a proof at all,
(1 - risk)^n <= level, which does not look at what is rejected. So the
guarantee holds for whichever cutoffs are chosen, at once for all strata. Among the cutoffs
that pass, the one with the largest surplus of bad over good rejected documents
is taken, then the one that rejects fewest good ones, then the loosest. A rule
that can't be proved in a stratum, or rejects no more bad than good, is off there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.llm.common import SPACE, strip, whole
from quernel.llm.common import words as words_of
from quernel.session import materialize

#: Fixed values of the contract: characters that count as symbols, and the base rule.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20

#: Cutoffs in per cent of the number of words, from loose to strict.
CUTOFFS = (400, 300, 200, 150, 100, 80, 60, 50, 40, 30, 25, 20, 15, 10, 7, 5)
RULES = ("n_symbols", "n_marks", "n_dup_lines", "n_repeat_words")
RISK, LEVEL = 0.01, 0.05

#: Terms of a binomial tail that are added one by one; the others are bounded from above.
TERMS = 2000


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows that are found twice or more in the array, the first included.

    A window's hash is made of its words. Only texts with a repeated one sort them.
    """

    def covered(starts: Column) -> Column:
        """Places covered by windows at these ascending starts."""
        steps = F.transform(
            starts, lambda s, i: F.when(i == 0, F.lit(window)).otherwise(F.least(F.lit(window), s - F.get(starts, i - 1)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def repeats(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(pairs, lambda p: _let(twice(p), covered))

    def twice(pairs: Column) -> Column:
        same = lambda p, j: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
        kept = F.filter(pairs, lambda p, i: same(p, i - 1) | same(p, i + 1))
        return F.sort_array(F.transform(kept, lambda p: p["i"].cast("bigint")))

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            repeats(hashes)
        )

    return F.when(F.size(words) < window + 1, F.lit(0).cast("bigint")).otherwise(
        _let(words, lambda w: _let(hashed(w), counted))
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def measures(docs: DataFrame, keys=("doc_id", "lang")) -> DataFrame:
    """The keys, and n_words, word_chars, n_symbols, n_marks, n_dup_lines, n_repeat_words, base_failed."""
    text = whole()
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")
    measured = docs.select(
        *keys,
        F.length(F.translate(text, SPACE, "")).cast("bigint").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        _count(text, "!").alias("n_marks"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        _let(
            words_of(text),
            lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("repeated")),
        ).alias("w"),
    )
    failed = (F.col("w.n") < LEAST_WORDS) | (100 * F.col("w.repeated") > MOST_REPEATED * F.col("w.n"))
    return measured.select(
        *measured.columns[: len(keys)], F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_marks", "n_dup_lines",
        F.col("w.repeated").alias("n_repeat_words"), failed.alias("base_failed"),
    )


def _log_factorial(n: Column) -> Column:
    """Stirling's series at n + 9, brought back by the product of what lies between; error below 1e-12 of the value."""
    z = n.cast("double") + 9.0
    between = F.lit(0.0)
    for k in range(1, 9):
        between = between + F.log(n.cast("double") + float(k))
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - between


def at_most_risk(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X binomial (n, risk): small if k of n proves a rate below the risk.

    Terms fall from k downwards below the mean, so they are added from k
    down; after ``TERMS`` of them the rest is bounded by a geometric series, which
    only makes the value larger. Above the mean the value is 1.
    """
    odds = (1 - risk) / risk
    k, n = k.cast("bigint"), n.cast("bigint")
    first = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
    first = F.exp(first + k * math.log(risk) + (n - k) * math.log1p(-risk))
    steps = F.when(k < 1, F.array().cast("array<bigint>")).otherwise(
        F.sequence(k, F.greatest(k - TERMS + 1, F.lit(1).cast("bigint")), F.lit(-1).cast("bigint"))
    )
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(state, i):
        term = state["term"] * i.cast("double") / (n - i + 1).cast("double") * odds
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    tail = F.aggregate(steps, start, add)
    ratio = F.greatest(k - TERMS, F.lit(0)).cast("double") / F.greatest(n - k + TERMS, F.lit(1)).cast("double") * odds
    rest = F.when(k <= TERMS, F.lit(0.0)).otherwise(tail["term"] * ratio / (1 - ratio))
    return F.when(n < 1, F.lit(1.0)).when(k >= risk * n, F.lit(1.0)).otherwise(first * (tail["sum"] + rest))


def _fails(rule: str, cutoff) -> Column:
    return 100 * F.col(rule) > cutoff * F.col("n_words")


def _hits(rule: str) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS]), lambda cutoff: _fails(rule, cutoff)))


def thresholds(measured: DataFrame, labels: DataFrame, stratum="lang", risk=RISK, level=LEVEL) -> DataFrame:
    """(stratum, rule, cutoff, n_good, rejected_good, rejected_bad, p_value) of the rules in force.

    A document with several labels counts as good only if all say so. Labels
    without a document, a document id or a value are left out.
    """
    graded = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"))
    )
    known = measured.filter(~F.col("base_failed")).join(graded, "doc_id")
    # The number of cutoffs that reject a document: they are nested, so it says which ones do.
    strictness = F.array(*[F.struct(F.lit(r).alias("rule"), _hits(r).alias("hit")) for r in RULES])
    at = known.select(F.col(stratum).alias("stratum"), "good", F.explode(strictness).alias("at"))
    counts = at.groupBy("stratum", "at.rule", "at.hit").agg(
        F.sum(F.when(F.col("good") >= 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("good") < 1, 1).otherwise(0)).alias("bad"),
    )
    counts = materialize(counts, "quality-counts")
    group = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"))
    table = F.array(*[F.struct(F.lit(i).alias("index"), F.lit(c).alias("cutoff")) for i, c in enumerate(CUTOFFS)])
    tests = group.withColumn("c", F.explode(table)).alias("t").join(
        counts.alias("x"),
        F.col("t.stratum").eqNullSafe(F.col("x.stratum"))
        & (F.col("t.rule") == F.col("x.rule"))
        # hit cutoffs are the strictest ones: the last ones of the list
        & (F.col("x.hit") >= len(CUTOFFS) - F.col("t.c.index")),
        "left",
    )
    tests = tests.groupBy("t.stratum", "t.rule", "t.n_good", F.col("t.c.cutoff").alias("cutoff")).agg(
        F.coalesce(F.sum("x.good"), F.lit(0)).alias("rejected_good"),
        F.coalesce(F.sum("x.bad"), F.lit(0)).alias("rejected_bad"),
    )
    tests = materialize(tests.withColumn("p_value", at_most_risk(F.col("n_good"), F.col("rejected_good"), risk)), "quality-tests")
    able = tests.filter(F.pow(F.lit(1 - risk), F.col("n_good")) <= level).select("stratum", "rule").distinct()
    corrected = level / max(1, able.count())
    gain = F.col("rejected_bad") - F.col("rejected_good")
    best = F.max_by(
        F.struct("cutoff", "n_good", "rejected_good", "rejected_bad", "p_value"),
        F.struct(gain, -F.col("rejected_good"), "cutoff"),
    )
    proved = tests.filter((F.col("p_value") <= corrected) & (gain > 0))
    return proved.groupBy("stratum", "rule").agg(best.alias("b")).select("stratum", "rule", "b.*")


def judge(docs: DataFrame, labels: DataFrame, keys=("doc_id", "lang"), risk=RISK, level=LEVEL) -> DataFrame:
    """``measures`` and ``kept``, a row per document.

    ``kept`` is false where the base rule or a rule in force in the document's
    language rejects. Null texts have no words and fail the base rule; a null language is a stratum of its own.
    Without labels no rule is in force. An empty table gives an empty table.
    """
    measured = materialize(measures(docs, keys), "quality-measures")
    chosen = thresholds(measured, labels, risk=risk, level=level)
    per_stratum = chosen.groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    )
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_fails(rule, F.col(f"cut_{rule}")), F.lit(False))
    return (
        measured.alias("m")
        .join(per_stratum, F.col("m.lang").eqNullSafe(F.col("stratum")), "left")
        .select("m.*", (~F.col("base_failed") & ~rejected).alias("kept"))
    )
