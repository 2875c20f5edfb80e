"""Word counts and JSON columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.functions import jsontext, text
from quernel.operators.aggregate import count_by
from quernel.plans.tables import table
from quernel.session import even_out


def _documents(spark, folder):
    return even_out(table(spark, folder, "documents").select("text"))


def word_count_ws(spark, folder):
    words = text.explode_words(_documents(spark, folder), "text")
    return count_by(words, "word").orderBy("word")


def word_count(spark, folder):
    words = text.explode_words(_documents(spark, folder), "text", punctuation=True, lower=True)
    return count_by(words, "word").orderBy("word")


def word_count_lines(spark, folder):
    words = text.explode_words(
        _documents(spark, folder), "text", punctuation=True, lower=True, space=text.ASCII_SPACE
    )
    return count_by(words, "word").select(text.key_value_line("word", "count").alias("line"))


def json_field(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return jsontext.json_fields(events, "props", "k bigint, missing string")


def json_rows(spark, folder):
    """The lines of the filter-and-route job, as JSON objects and arrays."""
    events = table(spark, folder, "events")
    score = (F.floor("value").cast("bigint") - 48).alias("score")
    rows = events.select("event_id", "event_type", "user_id", score)
    return rows.select(
        "event_id",
        jsontext.object_line("event_type", "user_id", "score").alias("as_object"),
        jsontext.array_line("event_type", "user_id", "score").alias("as_array"),
    )


QUERIES = {
    "word_count_ws": word_count_ws,
    "word_count": word_count,
    "word_count_lines": word_count_lines,
    "json_field": json_field,
    "json_rows": json_rows,
}

_WORDS = """
SELECT word, count(*) AS count
FROM (SELECT {word} AS word
      FROM (SELECT unnest(regexp_split_to_array(text, '[{separators}]+')) AS token FROM documents))
WHERE word <> ''
GROUP BY word
"""

_PUNCTUATED = _WORDS.format(
    word="lower(token)", separators=text.PUNCTUATION.replace("'", "''") + "{space}"
)

ORACLES = {
    "word_count_ws": _WORDS.format(word="token", separators=text.UNICODE_SPACE),
    "word_count": _PUNCTUATED.replace("{space}", text.UNICODE_SPACE),
    "word_count_lines": "SELECT word || ' ' || count AS line FROM ("
    + _PUNCTUATED.replace("{space}", text.ASCII_SPACE)
    + ")",
    "json_field": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.missing') AS missing
FROM events
""",
    "json_rows": """
SELECT event_id,
       CAST(to_json({'event_type': event_type, 'user_id': user_id, 'score': score}) AS VARCHAR) AS as_object,
       '["' || event_type || '",' || user_id || ',' || score || ']' AS as_array
FROM (SELECT *, CAST(floor(value) AS BIGINT) - 48 AS score FROM events)
""",
}
