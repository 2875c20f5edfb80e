"""Jobs on text, comments and page counts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quernel import sources
from quernel.functions import jsontext, text
from quernel.operators import aggregate, relative, routing, topgroup
from quernel.session import even_out, materialize


def word_count(
    spark: SparkSession,
    inputs: str,
    output: str,
    punctuation: bool = False,
    ascii_space: bool = False,
    tabbed: bool = False,
    partitions: int | None = None,
):
    """Words and their counts, in word order."""
    lines = even_out(sources.text_lines(spark, inputs), partitions)
    words = text.explode_words(
        lines,
        "value",
        punctuation=punctuation,
        lower=punctuation,
        space=text.ASCII_SPACE if ascii_space else text.UNICODE_SPACE,
    )
    counts = aggregate.count_by(words, "word").orderBy("word")
    if tabbed:
        sources.save_tabbed(counts, output)
    else:
        sources.save_lines(counts.select(text.key_value_line("word", "count").alias("line")), output)


def comment_means(spark: SparkSession, inputs: str, output: str, style: str = "csv"):
    """Mean comment score per group; ``json`` and ``tabbed`` are in group order."""
    means = aggregate.mean_by(sources.comments(spark, inputs), ["subreddit"], "score")
    if style == "csv":
        sources.save_csv(means, output)
    elif style == "json":
        line = jsontext.array_line("subreddit", "mean").alias("line")
        sources.save_lines(means.orderBy("subreddit").select(line), output)
    elif style == "tabbed":
        sources.save_tabbed(means.orderBy("subreddit"), output)
    else:
        raise ValueError(f"unknown style {style!r}")
    return means


def comment_routes(spark: SparkSession, inputs: str, output: str, folders: bool = False):
    """Comments of groups with an e in their name, by the sign of the score.

    One pass into ``route=positive`` and ``route=negative``; with ``folders``
    two filtered passes into ``positive`` and ``negative``.
    """
    rows = sources.comments(spark, inputs).select("subreddit", "author", "score")
    rows = routing.containing(rows, "subreddit")
    line = jsontext.array_line("subreddit", "author", "score")
    if folders:
        for name, part in zip(("positive", "negative"), routing.split_by_sign(rows, "score")):
            sources.save_lines(part.select(line.alias("line")), f"{output}/{name}")
        return
    known = rows.where(F.col("score").isNotNull())
    routed = known.select(line.alias("value"), routing.sign_route("score").alias("route"))
    sources.save_routed(routed, F.col("route"), output, "text")


def relative_scores(spark: SparkSession, inputs: str, output: str, strategy: str = "auto"):
    """Author and score relative to the group mean, highest first."""
    rows = sources.comments(spark, inputs).select("subreddit", "author", "score")
    # Read twice below: once for the means, once for the scores.
    rows = materialize(rows, "comments")
    scored = relative.relative_score(rows, "subreddit", "score", strategy=strategy)
    ordered = relative.by_score(scored.select("author", "relative"), "relative", "author")
    sources.save_lines(ordered.select(jsontext.array_line("author", "relative").alias("line")), output)


def _read_once(pages):
    """Pages are read for the maxima and again for the rows that hold them.

    Three columns in a written table are cheaper to read twice than text that
    cannot be split.
    """
    return materialize(pages.select("hour", "title", "views"), "pages")


def page_maxima(spark: SparkSession, inputs: str, output: str):
    """Most views of an article per hour, zero at least."""
    pages = topgroup.article_rows(sources.page_lines(spark, inputs))
    top = aggregate.max_by_group(pages, ["hour"], "views", floor=0)
    sources.save_tabbed(top.orderBy("hour"), output)


def page_tops(
    spark: SparkSession, inputs: str, output: str, single_file: bool = False, tabbed: bool = False
):
    """The most viewed article per hour, one per hour.

    ``tabbed`` gives ``hour TAB (title,views)``, with an empty title where no
    article was viewed.
    """
    pages = _read_once(topgroup.article_rows(sources.page_lines(spark, inputs)))
    best = topgroup.top_one(pages, "hour", "views", "title", floor=0 if tabbed else None).orderBy("hour")
    if tabbed:
        line = F.format_string("%s\t(%s,%s)", F.col("hour"), F.col("title"), F.col("views"))
    else:
        line = text.keyed_pair_line("hour", "views", "title")
    sources.save_lines(best.select(line.alias("line")), output, single_file=single_file)


def page_tops_by_file(spark: SparkSession, inputs: str, output: str, fold: bool = False):
    """All most viewed articles per hour, with the hour from the file name."""
    pages = topgroup.article_rows(sources.page_counts(spark, inputs), fold=fold)
    best = topgroup.top_rows(_read_once(pages), "hour", "views").orderBy("hour", "title")
    sources.save_json(best, output)
    return best
