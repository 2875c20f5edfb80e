"""Secret scan with multipart credential linking.

The base finds assignments, access ids and hex strings by pattern. Weak
candidates (short access ids, named identifiers such as ``client_id=``, short assigned
values, mixed blobs, endpoints) are reported only together: an interval join looks for the parts
that complete them, in the same document and with at most ``SCOPE`` code points between
the end of one and the start of the other. Parts that overlap don't complete each other.

Places come from the lengths of the matches and of the text between them, added up by a
window per document and kind. Text is read once and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.llm.common import whole
from quernel.session import materialize

#: Fixed values of the contract: kinds in order, patterns, and least lengths.
KINDS = ("assign", "access", "hex", "id", "blob", "endpoint")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18

#: Weak candidates: code points between complementary parts, and their own patterns and lengths.
SCOPE = 200
IDENTIFIER = r"""(?i)(client_?id|access_?key_?id|access_?key|user_?name|user_?id|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})"""
BLOB = r"[A-Za-z0-9+/]{20,}"
ENDPOINT = r"https?://[A-Za-z0-9._:/-]+"
LEAST_WEAK_ASSIGNED, LEAST_WEAK_ACCESS = 6, 8


def _matches(text: Column, kind: int, pattern: str, value_group: int, only: Column) -> Column:
    """Array of (kind, i, gap, n, value): text before the match since the last one, its length, its value's length.

    A blob's value is 1 if it has upper and lower case and a digit.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if KINDS[kind] == "blob":
        mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
        value = F.transform(found, lambda m: mixed(m).cast("int"))
    elif value_group:
        value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), F.length)
    else:
        value = F.transform(found, F.length)
    rows = F.zip_with(
        F.arrays_zip(F.transform(found, F.length).alias("n"), value.alias("value")),
        F.transform(F.split(text, pattern), F.length),
        lambda m, gap: F.struct(
            F.lit(kind).alias("kind"), gap.alias("gap"), m["n"].alias("n"), m["value"].alias("value")
        ),
    )
    # Text after the last match is a piece without a match.
    rows = F.slice(rows, F.lit(1), F.size(rows) - 1)
    none = F.array().cast("array<struct<kind:int,gap:int,n:int,value:int>>")
    return F.when(only & text.rlike(pattern), rows).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, parts): all matches of all kinds; blobs only where the text has an identifier at all."""
    text = whole()
    always, named = F.lit(True), F.col("named")
    parts = [
        _matches(text, 0, ASSIGN, 2, always),
        _matches(text, 1, ACCESS, 0, always),
        _matches(text, 2, HEX, 0, always),
        _matches(text, 3, IDENTIFIER, 2, named),
        _matches(text, 4, BLOB, 0, named | text.contains("AKIA")),
        _matches(text, 5, ENDPOINT, 0, text.contains("://")),
    ]
    read = docs.select("doc_id", "text", text.rlike(IDENTIFIER).alias("named"))
    return read.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*parts).alias("parts"))


def spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end, value) of all matches, in code points, end exclusive."""
    each = scanned.filter(F.size("parts") > 0).select("row", F.posexplode("parts").alias("i", "part"))
    each = each.select("row", "i", "part.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far))
    return placed.select("row", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value")


def _near(left: DataFrame, right: DataFrame, within: int = SCOPE) -> DataFrame:
    """Spans of ``left`` with one of ``right`` before or after them, at most ``within`` code points between.

    The end of one meets the start of the other in bins of that width, whatever the spans' lengths: side 1
    is a right span behind the left one, side -1 one before it.
    """

    def ends(after: str, before: str) -> Column:
        sides = [F.struct(F.lit(s).alias("side"), F.col(c).alias("at")) for s, c in ((1, after), (-1, before))]
        return F.explode(F.array(*sides))

    a = left.withColumn("e", ends("end", "start")).withColumn("bin", F.floor(F.col("e.at") / within)).alias("a")
    b = right.select("row", ends("start", "end").alias("e"))
    b = b.withColumn("bin", F.explode(F.array(*[F.floor(F.col("e.at") / within) - F.col("e.side") * k for k in (0, 1)])))
    b = b.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("row", "bin", "e.side")]
    close = (F.col("a.e.side") * (F.col("b.e.at") - F.col("a.e.at"))).between(0, within)
    return a.join(b, same[0] & same[1] & same[2] & close, "left_semi").select(left.columns).distinct()


def link(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, added) spans (row, kind, start, end) from ``spans``.

    Added are: a weak identifier (a short access id, a named one) with a secret in scope (a base
    assignment or hex string, a short assigned value, a blob outside base and identifier spans); a weak
    secret of these with an identifier in scope, a short assigned value also with an endpoint; an endpoint
    with an assigned value in scope, or with an identifier and any secret.
    """
    is_kind = lambda k: F.col("kind") == KINDS.index(k)
    strong = (
        (is_kind("assign") & (F.col("value") >= LEAST_ASSIGNED))
        | (is_kind("access") & (F.col("value") >= LEAST_ACCESS))
        | is_kind("hex")
    )
    base = found.filter(strong)
    short_ids = found.filter(is_kind("access") & F.col("value").between(LEAST_WEAK_ACCESS, LEAST_ACCESS - 1))
    weak_ids = short_ids.withColumn("kind", F.lit(KINDS.index("id"))).union(found.filter(is_kind("id")))
    short_values = found.filter(
        is_kind("assign") & F.col("value").between(LEAST_WEAK_ASSIGNED, LEAST_ASSIGNED - 1)
    )
    blobs = _outside(found.filter(is_kind("blob") & (F.col("value") == 1)), base.union(weak_ids))
    endpoints = found.filter(is_kind("endpoint"))
    ids = base.filter(is_kind("access")).union(weak_ids)
    assigned = base.filter(is_kind("assign")).union(short_values)
    weak_secrets = short_values.union(blobs)
    secrets = base.filter(~is_kind("access")).union(weak_secrets)
    added = (
        _near(weak_ids, secrets)
        .union(_near(weak_secrets, ids))
        .union(_near(short_values, endpoints))
        .union(_near(endpoints, assigned))
        .union(_near(_near(endpoints, ids), secrets))
    )
    # A part may be completed in several ways.
    return base.drop("value"), added.drop("value").distinct()


def _outside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Spans of ``left`` that don't overlap one of ``right``: an anti join on the bins that both cover."""
    covered = lambda: F.explode(
        F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE))
    )
    a = left.withColumn("bin", covered()).alias("a")
    b = right.select("row", "start", "end", covered().alias("bin")).alias("b")
    overlap = (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end"))
    hit = a.join(b, (F.col("a.row") == F.col("b.row")) & (F.col("a.bin") == F.col("b.bin")) & overlap, "left_semi")
    return left.join(hit.select("row", "start").distinct(), ["row", "start"], "left_anti").select(left.columns)


def _text(list_of_spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(
        F.sort_array(list_of_spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    )
    return F.array_join(each, ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans), a row per document.

    ``base`` and ``spans`` (base and added ones) are kind:start:end by start, then
    kind in the order of ``KINDS``, joined by commas. A null text has none, a very long one is scanned as a
    whole, and repeated parts are all reported. Rows with
    the same id, or with none, are scanned one by one. An empty table gives an empty table.
    """
    scanned = materialize(scan(docs), "secret-matches")
    base, added = link(materialize(spans(scanned), "secret-spans"))
    every = base.withColumn("is_base", F.lit(True)).union(added.withColumn("is_base", F.lit(False)))
    span = F.struct("start", "kind", "end")
    counts = [F.count_if(F.col("is_base") & (F.col("kind") == k)).alias(f"n_{KINDS[k]}") for k in range(3)]
    per_row = every.groupBy("row").agg(
        *counts,
        F.collect_list(F.when(F.col("is_base"), span)).alias("base"),
        F.collect_list(span).alias("spans"),
    )
    out = scanned.select("row", "doc_id").join(per_row, "row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        *[F.coalesce(_text(F.col(c)), F.lit("")).alias(c) for c in ("base", "spans")],
    )
