from conftest import rows
from pyspark.sql import functions as F

from quernel.functions import jsontext, text, weblog


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def words(df, **how):
    return [r.word for r in text.explode_words(df, "value", **how).collect()]


def test_words_split_on_any_space_and_drop_empties(spark):
    df = lines(spark, "", "  a\tb ", "c d e")
    assert words(df) == ["a", "b", "c", "d", "e"]
    assert words(df, space=text.ASCII_SPACE) == ["a", "b", "c d e"]


def test_words_split_on_punctuation_and_fold_case(spark):
    df = lines(spark, "'Tis the_End--of[it]; a^b\\c", "...")
    assert words(df, punctuation=True, lower=True) == ["tis", "the", "end", "of", "it", "a", "b", "c"]


def test_every_ascii_punctuation_mark_separates(spark):
    import string

    df = lines(spark, *[f"a{mark}b" for mark in string.punctuation])
    assert words(df, punctuation=True) == ["a", "b"] * len(string.punctuation)


def test_python_and_column_agree_on_space(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    df = lines(spark, *[f"a{s}b" for s in spaces])
    assert words(df) == ["a", "b"] * len(spaces)


def test_fields_past_the_end_are_null(spark):
    df = lines(spark, "1 2", "3").select(*text.fields("value", " ", ["x", "y"]))
    assert df.collect() == [("1", "2"), ("3", None)]


def test_log_lines(spark):
    good = 'h1 - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 624'
    bad = [
        'h1 - - [01/Jul/1995:00:00:02 -0400] "GET /x HTTP/1.0" 304 -',
        'h1 - - [01/Jul/1995:00:00:02 -0400] "GET /x" 200 7',
        good + " more",
        " " + good,
        "h1 01/Jul/1995:00:00:01 /x 624",
        "",
    ]
    parsed = weblog.parse_log(lines(spark, good, *bad))
    shown = parsed.select("host", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"), "path", "bytes")
    assert rows(shown) == [("h1", "1995-07-01 00:00:01", "/x", 624)]


def test_log_records_drop_impossible_times(spark):
    line = 'h1 - - [31/Feb/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 624'
    assert weblog.parse_log(lines(spark, line)).count() == 1
    assert weblog.load_records(lines(spark, line)).count() == 0


def test_row_ids(spark):
    line = 'h1 - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 624'
    df = lines(spark, line, line)
    assert len({r.id for r in weblog.load_records(df).collect()}) == 2
    assert len({r.id for r in weblog.load_records(df, kind="hash").collect()}) == 1


def test_log_pattern_runs_once(spark, tmp_path):
    from conftest import plan_of

    lines(spark, "x").write.text(str(tmp_path / "t"))
    plan = plan_of(weblog.load_records(spark.read.text(str(tmp_path / "t"))), "simple")
    assert plan.count("regexp_replace") == 1


def test_json_fields_missing_is_null(spark):
    df = spark.createDataFrame([(1, '{"a": 5}'), (2, '{"b": "x"}'), (3, "no")], "id int, j string")
    out = jsontext.json_fields(df, "j", "a bigint, b string")
    assert rows(out.select("id", F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit("")))) == [
        (1, 5, ""),
        (2, 0, "x"),
        (3, 0, ""),
    ]


def test_json_lines(spark):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    out = df.select(jsontext.object_line("k", "v"), jsontext.array_line("k", "v")).first()
    assert tuple(out) == ('{"k":"a","v":1.5}', '["a",1.5]')
