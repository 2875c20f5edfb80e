"""One registered query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.llm import (
    decontaminate,
    html_text,
    licenses,
    line_dedup,
    lm,
    merkle,
    mixing,
    near_dup,
    quality,
    search,
    secret_scan,
    sharding,
    token_output,
)
from quernel.llm.common import documents
from quernel.sources import load_table


def op1_line_dedup(spark, folder):
    kept = line_dedup.dedup_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_output(spark, folder):
    import public_tokenizers

    vocabulary = public_tokenizers.path(token_output.VOCABULARY)
    return token_output.round_trip(documents(spark, folder), vocabulary)


def op3_sharding(spark, folder):
    return sharding.shard(documents(spark, folder))


def op4_quality_rules(spark, folder):
    judged = quality.judge(documents(spark, folder), load_table(spark, "labels", folder=folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_decontamination(spark, folder):
    found = decontaminate.contamination(documents(spark, folder), load_table(spark, "benchmark", folder=folder))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op6_license_scan(spark, folder):
    found = licenses.scan(documents(spark, folder))
    dice = F.array_max(F.transform("matches", lambda m: m["dice"]))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
        F.round(dice, 6).alias("best_dice"),
    )


def op7_mixing(spark, folder):
    mixed = mixing.mix(documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_near_duplicates(spark, folder):
    found = near_dup.near_duplicates(documents(spark, folder))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_secret_scan(spark, folder):
    found = secret_scan.find_secrets(documents(spark, folder))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op10_lm_scoring(spark, folder):
    return lm.score(documents(spark, folder))


def op11_lexical_search(spark, folder):
    return search.search(documents(spark, folder), load_table(spark, "benchmark", folder=folder))


def op12_html_extraction(spark, folder):
    pages = html_text.extract(load_table(spark, "pages", folder=folder))
    return pages.select("page_id", "url", "text", "n_chars")


def op13_merkle_manifest(spark, folder):
    docs = documents(spark, folder)
    hit = F.crc32(docs["doc_id"].cast("string")) % 7 == 0
    tampered = merkle.leaf_of(docs, changed={"n_chars": F.when(hit, docs["n_chars"] + 1).otherwise(docs["n_chars"])})
    rows = merkle.manifest(docs, extra={"tampered": tampered})
    return merkle.verified(rows, F.col("tampered")).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root",
        "verified",
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_output": op2_token_output,
    "op3_sharding": op3_sharding,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_lexical_search": op11_lexical_search,
    "op12_html_extraction": op12_html_extraction,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_SPACE = r"[\x20\x09-\x0D]"

_QUALITY = rf"""
WITH RECURSIVE texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts),
grams AS (
  SELECT doc_id, i, concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) > 4)),
often AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM often)
  GROUP BY doc_id),
m AS (
  SELECT s.doc_id, s.lang, len(w) AS n_words, len(regexp_replace(t, '{_SPACE}+', '', 'g')) AS word_chars,
         len(t) - len(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(t) - len(replace(t, '!', '')) AS n_marks,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM split AS s LEFT JOIN covered AS c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
good AS (SELECT doc_id, min(quality) >= 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
values_of AS (
  SELECT lang, good, n_words, unnest([struct_pack(r := 's', v := n_symbols), struct_pack(r := 'm', v := n_marks),
         struct_pack(r := 'd', v := n_dup_lines), struct_pack(r := 'r', v := n_repeat_words)]) AS x
  FROM b JOIN good USING (doc_id) WHERE NOT base_failed),
tests AS (
  SELECT lang, x.r AS r, c, count(*) FILTER (good) AS n, count(*) FILTER (good AND 100 * x.v > c * n_words) AS k,
         count(*) FILTER (NOT good AND 100 * x.v > c * n_words) AS bad
  FROM values_of, (SELECT unnest([{", ".join(map(str, quality.CUTOFFS))}]) AS c) GROUP BY ALL),
tails AS (
  SELECT lang, r, c, n, k, bad,
    CASE WHEN n = 0 OR k >= {quality.RISK} * n THEN 1.0 ELSE
      list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
        + i * ln({quality.RISK}) + (n - i) * ln(1 - {quality.RISK})))) END AS p
  FROM tests),
chosen AS (
  SELECT lang, r, arg_max(c, struct_pack(gain := bad - k, k := -k, c := c)) AS c
  FROM tails WHERE bad > k AND p <= {quality.LEVEL} / (
    SELECT greatest(1, count(DISTINCT (lang, r))) FROM tails WHERE pow(1 - {quality.RISK}, n) <= {quality.LEVEL}) GROUP BY lang, r),
cuts AS (
  SELECT lang, max(c) FILTER (r = 's') AS s, max(c) FILTER (r = 'm') AS m, max(c) FILTER (r = 'd') AS d,
         max(c) FILTER (r = 'r') AS r
  FROM chosen GROUP BY lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         coalesce(100 * n_symbols > s * n_words, false) OR coalesce(100 * n_marks > m * n_words, false)
         OR coalesce(100 * n_dup_lines > d * n_words, false) OR coalesce(100 * n_repeat_words > r * n_words, false)
       ) AS kept
FROM b LEFT JOIN cuts ON b.lang IS NOT DISTINCT FROM cuts.lang
"""

_LEAKS = r"""
WITH word_lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_lists AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_lists WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word_lists, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, g)),
per_word AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
per_item AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(p.n, 0) > 0 AS contaminated
FROM word_lists AS d LEFT JOIN per_word AS p USING (doc_id) LEFT JOIN per_item AS i USING (doc_id)
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, pos, l[pos] AS line,
         translate(trim(l[pos], chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
copied AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(last) FILTER (doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last IS NULL OR doc_id = last), ''))
         AS kept_sha256
FROM lines LEFT JOIN copied USING (key) GROUP BY doc_id
"""

_PLACES = """
  SELECT doc_id, kind, pos, value, CAST(start AS BIGINT) AS start, CAST(start + n AS BIGINT) AS stop
  FROM (
    SELECT doc_id, kind, pos, v[pos] AS value, length(m[pos]) AS n,
           list_sum(list_transform(p[1:pos], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1:pos - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS pos FROM found))
"""


def _found(kind: int, pattern: str, group: int, where: str = "true") -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS m,
         regexp_extract_all(t, '{pattern}', {group}) AS v, string_split_regex(t, '{pattern}') AS p
  FROM texts WHERE {where}"""



def _beside(parts: str) -> str:
    """A row of ``parts`` before or behind x, at most the scope away."""
    return f"""EXISTS (FROM {parts} AS y WHERE x.doc_id = y.doc_id
    AND greatest(x.start, y.start) - least(x.stop, y.stop) BETWEEN 0 AND {secret_scan.SCOPE})"""


_SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  {_found(0, secret_scan.ASSIGN, 2)} UNION ALL {_found(1, secret_scan.ACCESS, 0)}
  UNION ALL {_found(2, secret_scan.HEX, 0)} UNION ALL {_found(3, secret_scan.IDENTIFIER, 2)}
  UNION ALL {_found(4, secret_scan.BLOB, 0)} UNION ALL {_found(5, secret_scan.ENDPOINT, 0)}),
places AS ({_PLACES}),
base AS (
  SELECT * FROM places
  WHERE kind = 0 AND length(value) >= 12 OR kind = 1 AND length(value) >= 18 OR kind = 2),
weak_ids AS (
  SELECT * REPLACE (3 AS kind) FROM places WHERE kind = 3 OR kind = 1 AND length(value) BETWEEN 8 AND 17),
short_values AS (SELECT * FROM places WHERE kind = 0 AND length(value) BETWEEN 6 AND 11),
not_blobs AS (FROM base UNION ALL FROM weak_ids),
weak_secrets AS (
  FROM short_values
  UNION ALL
  SELECT * FROM places AS p
  WHERE kind = 4 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]')
    AND regexp_matches(value, '[a-z]')
    AND NOT EXISTS (FROM not_blobs AS b WHERE b.doc_id = p.doc_id AND p.start < b.stop AND b.start < p.stop)),
ids AS (SELECT * FROM base WHERE kind = 1 UNION ALL FROM weak_ids),
assigned AS (SELECT * FROM base WHERE kind = 0 UNION ALL FROM short_values),
secrets AS (SELECT * FROM base WHERE kind <> 1 UNION ALL FROM weak_secrets),
endpoints AS (SELECT * FROM places WHERE kind = 5),
added AS (
  SELECT doc_id, kind, start, stop FROM weak_ids AS x WHERE {_beside("secrets")}
  UNION
  SELECT doc_id, kind, start, stop FROM weak_secrets AS x
  WHERE {_beside("ids")} OR kind = 0 AND {_beside("endpoints")}
  UNION
  SELECT doc_id, kind, start, stop FROM endpoints AS x
  WHERE {_beside("assigned")} OR {_beside("ids")} AND {_beside("secrets")}),
every AS (SELECT doc_id, kind, start, stop, true AS b FROM base UNION ALL SELECT *, false FROM added),
named AS (
  SELECT *, concat_ws(':', [{", ".join(repr(k) for k in secret_scan.KINDS)}][kind + 1], start, stop) AS s FROM every)
SELECT d.doc_id, count(*) FILTER (b AND kind = 0) AS n_assign, count(*) FILTER (b AND kind = 1) AS n_access,
       count(*) FILTER (b AND kind = 2) AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (b), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, kind), '') AS spans
FROM texts AS d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id
"""

_TEMPLATES = ", ".join("(" + repr(k) + ", '" + v.replace("'", "''") + "')" for k, v in licenses.TEMPLATES.items())
_NORMAL = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_BIGRAMS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
_LICENSES = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents
  UNION ALL
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\n[\x20\x09-\x0D]*\n'),
         lambda x: contains(x, chr(10))) FROM documents),
segments AS (
  SELECT row_number() OVER () AS s, doc_id, {_NORMAL.format("part")} AS w
  FROM (SELECT doc_id, unnest(p) AS part FROM parts)),
pieces AS (SELECT s, doc_id, len(w) - 1 AS n, unnest({_BIGRAMS}) AS g FROM segments WHERE len(w) > 1),
have AS (SELECT s, doc_id, n, g, count(*) AS c FROM pieces GROUP BY ALL),
templates AS (SELECT name, {_NORMAL.format("body")} AS w FROM (VALUES {_TEMPLATES}) AS t(name, body)),
want AS (
  SELECT name, n, g, count(*) AS c
  FROM (SELECT name, len(w) - 1 AS n, unnest({_BIGRAMS}) AS g FROM templates) GROUP BY ALL),
matches AS (
  SELECT s, doc_id, name, 2 * sum(least(have.c, want.c)) / (have.n + want.n) AS dice
  FROM have JOIN want USING (g) GROUP BY s, doc_id, name, have.n, want.n
  HAVING 2 * sum(least(have.c, want.c)) / (have.n + want.n) >= {licenses.BOUND}
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY dice DESC, want.n DESC, name) = 1),
per_doc AS (
  SELECT doc_id, count(*) AS n, max(dice) AS best, string_agg(DISTINCT name, ',' ORDER BY name) AS names
  FROM matches GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, round(best, 6) AS best_dice
FROM documents AS d LEFT JOIN per_doc USING (doc_id)
"""

_SEARCH = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
docs AS (SELECT doc_id, d, t, len(t) AS n FROM words WHERE len(t) > 0),
corpus AS (SELECT count(*) AS nn, sum(n) AS ll FROM docs),
postings AS (SELECT doc_id, d, n, term, count(*) AS tf FROM (SELECT doc_id, d, n, unnest(t) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, nn),
asked AS (
  SELECT item_id, i, term, count(*) AS times
  FROM (SELECT item_id, i, unnest(t) AS term FROM (
    SELECT item_id, row_number() OVER () AS i, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark))
  GROUP BY ALL),
scores AS (
  SELECT item_id, i, doc_id, d, CAST(sum(times * w * ((1000000000 * tf) //
         (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // CAST(ll AS BIGINT))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY ALL)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, d) AS r FROM scores WHERE score > 0)
WHERE r <= 10
"""

# CRC-32 of a short text: a table of 256 words, then a byte at a time.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"""
_MERKLE = f"""
WITH RECURSIVE crc_table AS (SELECT {_CRC_TABLE} AS t),
sums AS (
  SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents), crc_table),
fields AS (
  SELECT d.doc_id, lang, n_chars, coalesce(crc % 7 = 0, false) AS hit,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents AS d LEFT JOIN sums USING (doc_id)),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + hit::INT AS VARCHAR)) || ':' || (n_chars + hit::INT), '-') || tail) AS other
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM levels WHERE len(nodes) > 1),
trees AS (
  SELECT lang, nodes[1] AS subroot, level AS height,
    row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM trees HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT p.doc_id, p.leaf, p.other, p.lang, p.place, l.level, p.place >> l.level AS i, l.nodes
  FROM placed AS p JOIN levels AS l ON l.lang IS NOT DISTINCT FROM p.lang AND len(l.nodes) > 1
  UNION ALL
  SELECT p.doc_id, p.leaf, p.other, p.lang, p.place, t.height + o.level, t.tree >> o.level, o.nodes
  FROM placed AS p JOIN trees AS t ON t.lang IS NOT DISTINCT FROM p.lang JOIN tops AS o ON len(o.nodes) > 1),
sides AS (
  SELECT lang, place, level, CASE WHEN i % 2 = 1 THEN nodes[i] ELSE '' END AS a,
    CASE WHEN i % 2 = 0 THEN coalesce(nodes[i + 2], '') ELSE '' END AS b FROM steps),
proofs AS (SELECT lang, place, list({{'a': a, 'b': b}} ORDER BY level) AS s FROM sides GROUP BY ALL),
folded AS (
  SELECT p.lang, p.place, p.doc_id, p.leaf, coalesce(s, []) AS s, 0 AS k, p.other AS node
  FROM placed AS p LEFT JOIN proofs AS q ON q.lang IS NOT DISTINCT FROM p.lang AND q.place = p.place
  UNION ALL
  SELECT lang, place, doc_id, leaf, s, k + 1, sha256(s[k + 1].a || node || s[k + 1].b) FROM folded WHERE k < len(s))
SELECT f.doc_id, f.leaf, t.subroot, r.nodes[1] AS root,
  sha256(array_to_string(list_transform(s, lambda x: x.a || x.b), '')) AS proof_sha256, node AS folded_root,
  node = r.nodes[1] AS verified
FROM folded AS f JOIN trees AS t ON t.lang IS NOT DISTINCT FROM f.lang JOIN tops AS r ON len(r.nodes) = 1
WHERE k = len(s)
"""

# The shuffled order is a hash that SQL does not have; all but ``taken`` is checked by SQL in the tests.

ORACLES = {
    "op1_line_dedup": _LINES,
    "op4_quality_rules": _QUALITY,
    "op5_decontamination": _LEAKS,
    "op6_license_scan": _LICENSES,
    "op9_secret_scan": _SECRETS,
    "op11_lexical_search": _SEARCH,
    "op13_merkle_manifest": _MERKLE,
}
