"""``python -m quernel.jobs <job> ...``: every job on a command line."""

from __future__ import annotations

import argparse
import datetime

from quernel.jobs import models, tables, text
from quernel.session import get_spark


def _options(pairs) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs or [])


def _store(parser):
    parser.add_argument("--format", default="parquet", help="table format or connector")
    parser.add_argument("--option", action="append", metavar="NAME=VALUE", help="connector option")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quernel.jobs")
    parser.add_argument(
        "--explain", action="store_true", help="print the plan (comment-means, page-tops-by-file, order-report)"
    )
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, *positional, help=None):
        sub = jobs.add_parser(name, help=help)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    sub = job("word-count", "inputs", "output")
    sub.add_argument("--punctuation", action="store_true", help="also split on punctuation; lower-case")
    sub.add_argument("--ascii-space", action="store_true")
    sub.add_argument("--tabbed", action="store_true")
    sub.add_argument("--partitions", type=int)
    job("comment-means", "inputs", "output").add_argument(
        "--style", choices=["csv", "json", "tabbed"], default="csv"
    )
    job("comment-routes", "inputs", "output").add_argument("--folders", action="store_true")
    job("relative-scores", "inputs", "output").add_argument(
        "--strategy", choices=["auto", "broadcast", "shuffle", "window"], default="auto"
    )
    job("page-maxima", "inputs", "output")
    sub = job("page-tops", "inputs", "output")
    sub.add_argument("--single-file", action="store_true")
    sub.add_argument("--tabbed", action="store_true")
    job("page-tops-by-file", "inputs", "output").add_argument("--fold", action="store_true")
    job("weather-etl", "inputs", "output")
    job("temperature-ranges", "inputs", "output").add_argument("--sql", action="store_true")
    job("correlate-logs", "inputs")
    sub = job("correlate-table", "table")
    sub.add_argument("--folder")
    _store(sub)
    sub = job("load-logs", "inputs")
    sub.add_argument("--path")
    sub.add_argument("--partitions", type=int)
    sub.add_argument("--key", choices=["uuid", "hash"], default="uuid")
    _store(sub)
    sub = job("shortest-path", "inputs", "output")
    sub.add_argument("source", type=int)
    sub.add_argument("dest", type=int)
    sub.add_argument("--debug", action="store_true", help="write the paths of each round")
    sub.add_argument("--max-hops", type=int, default=6, help="most edges of the path; 0 for any number")
    for name in ("order-report", "order-lookup"):
        sub = job(name, "output")
        sub.add_argument("keys", nargs="+")
        sub.add_argument("--folder")
        _store(sub)
    sub = job("denormalize")
    sub.add_argument("--folder")
    sub.add_argument("--path")
    sub.add_argument("--out-option", action="append", metavar="NAME=VALUE")
    _store(sub)
    for name, *positional in (("wide-create", "path"), ("wide-refresh", "path"), ("wide-lookup", "path", "output")):
        sub = job(name, *positional)
        if name != "wide-create":
            sub.add_argument("keys", nargs="+", help="part keys" if name == "wide-refresh" else "order keys")
        if name != "wide-lookup":
            sub.add_argument("--folder")
            _store(sub)
        sub.add_argument("--buckets", type=int, default=tables.BUCKETS, help="the same for all commands on a table")
    sub = job("stream-line")
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--path", help="of a file source")
    sub.add_argument("--schema", help="of a file source, such as 'value string'")
    sub.add_argument("--ledger", help="folder of the sums so far; with --checkpoint the job can be started again")
    sub.add_argument("--checkpoint")
    sub.add_argument("--once", action="store_true", help="take what is there and end")
    sub.add_argument("--every", metavar="INTERVAL", help="time between batches, such as '10 seconds'")
    sub.add_argument("--option", action="append", metavar="NAME=VALUE")
    sub.add_argument("--seconds", type=int, default=600)
    sub = job("train-colours", "inputs")
    sub.add_argument("--kind", choices=["perceptron", "logistic"], default="perceptron")
    sub.add_argument("--seed", type=int)
    sub.add_argument("--grid")
    sub = job("train-tmax", "inputs", "model")
    sub.add_argument("--no-yesterday", action="store_true")
    sub.add_argument("--iterations", type=int, default=20)
    sub.add_argument("--depth", type=int, default=10)
    sub.add_argument("--seed", type=int, default=1)
    job("test-tmax", "model", "inputs")
    sub = job("predict-tmax", "model")
    sub.add_argument("day", type=datetime.date.fromisoformat)
    for name in ("latitude", "longitude", "elevation", "tmax"):
        sub.add_argument(name, type=float)
    return parser


def run(spark, args) -> None:
    result = _run(spark, args)
    if args.explain and result is not None:
        result.explain()


def _run(spark, args):
    a = args
    if a.job == "word-count":
        text.word_count(spark, a.inputs, a.output, a.punctuation, a.ascii_space, a.tabbed, a.partitions)
    elif a.job == "comment-means":
        return text.comment_means(spark, a.inputs, a.output, a.style)
    elif a.job == "comment-routes":
        text.comment_routes(spark, a.inputs, a.output, a.folders)
    elif a.job == "relative-scores":
        text.relative_scores(spark, a.inputs, a.output, a.strategy)
    elif a.job == "page-maxima":
        text.page_maxima(spark, a.inputs, a.output)
    elif a.job == "page-tops":
        text.page_tops(spark, a.inputs, a.output, a.single_file, a.tabbed)
    elif a.job == "page-tops-by-file":
        return text.page_tops_by_file(spark, a.inputs, a.output, a.fold)
    elif a.job == "weather-etl":
        tables.weather_etl(spark, a.inputs, a.output)
    elif a.job == "temperature-ranges":
        tables.temperature_ranges(spark, a.inputs, a.output, a.sql)
    elif a.job == "correlate-logs":
        tables.correlate_logs(spark, a.inputs).show(truncate=False)
    elif a.job == "correlate-table":
        tables.correlate_table(spark, a.table, a.format, a.folder, **_options(a.option)).show(truncate=False)
    elif a.job == "load-logs":
        tables.load_logs(spark, a.inputs, a.path, a.format, a.partitions, a.key, **_options(a.option))
    elif a.job == "shortest-path":
        tables.shortest_path(spark, a.inputs, a.output, a.source, a.dest, a.debug, a.max_hops or None)
    elif a.job == "order-report":
        return tables.order_report(spark, a.output, a.keys, a.format, a.folder, **_options(a.option))
    elif a.job == "order-lookup":
        tables.order_lookup(spark, a.output, a.keys, a.format, a.folder, **_options(a.option))
    elif a.job == "denormalize":
        tables.denormalize(spark, a.path, a.format, a.folder, _options(a.out_option), **_options(a.option))
    elif a.job == "stream-line":
        result = tables.stream_line(
            spark, a.format, a.seconds, path=a.path, schema=a.schema, ledger=a.ledger, checkpoint=a.checkpoint,
            once=a.once, every=a.every, **_options(a.option),
        )
        if result is not None:
            result.show(truncate=False)
    elif a.job == "wide-create":
        print(tables.wide_create(spark, a.path, a.format, a.folder, a.buckets, **_options(a.option)))
    elif a.job == "wide-refresh":
        print(tables.wide_refresh(spark, a.path, a.keys, a.format, a.folder, a.buckets, **_options(a.option)))
    elif a.job == "wide-lookup":
        tables.wide_lookup(spark, a.path, a.output, a.keys, a.buckets)
    elif a.job == "train-colours":
        models.train_colours(spark, a.inputs, a.kind, a.seed, a.grid).show()
    elif a.job == "train-tmax":
        settings = {"max_iter": a.iterations, "max_depth": a.depth, "seed": a.seed}
        models.train_tmax(spark, a.inputs, a.model, not a.no_yesterday, **settings).show()
    elif a.job == "test-tmax":
        for result in models.test_tmax(spark, a.model, a.inputs):
            result.show(truncate=False)
    elif a.job == "predict-tmax":
        models.predict_next_day(
            spark, a.model, a.day, a.latitude, a.longitude, a.elevation, a.tmax
        ).show()
    return None


def main(argv=None) -> None:
    args = build_parser().parse_args(argv)
    run(get_spark(f"quernel {args.job}"), args)


if __name__ == "__main__":
    main()
