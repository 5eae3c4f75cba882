"""Command line: one sub-command per stage. Options override the YAML file, which overrides the defaults."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import annotate
from tidemark.functions.keys import symbol_key
from tidemark.operators import clean, daily, market, replies, requests
from tidemark.session import build_session, clean_up
from tidemark.sources import files, readers, sinks
from tidemark.sources.replies import reply_lines

BARS = "day date, symbol string, Open double, High double, Low double, Close double, `Adj Close` double, Volume bigint"
TEXT_OPTIONS = ("input", "output", "comments", "replies", "prices", "start", "end", "kind", "seeds", "aliases", "prompt", "model", "client", "log", "form", "posts")
NUMBER_OPTIONS = ("window_seconds", "max_lines", "max_days", "per_part", "per_request", "max_chars", "least_chars", "in_flight", "batch")


def settings(argv: list[str]) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--config")
    common.add_argument("--master", default=None)
    for name in TEXT_OPTIONS:
        common.add_argument(f"--{name}")
    for name in NUMBER_OPTIONS:
        common.add_argument(f"--{name.replace('_', '-')}", type=int)
    common.add_argument("--force", action="store_true", default=None)
    common.add_argument("--drop-nsfw", action="store_true", default=None)
    common.add_argument("--subreddits", nargs="*")
    common.add_argument("--pause", type=float)
    common.add_argument("--scope", choices=["history", "partition"])
    parser = argparse.ArgumentParser(prog="tidemark")
    stages = parser.add_subparsers(dest="stage", required=True)
    for name in STAGES:
        stages.add_parser(name, parents=[common])
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
    defaults = {
        "master": "local[*]", "force": False, "drop_nsfw": False, "window_seconds": 3600, "scope": "history", "subreddits": list(readers.SUBREDDITS), "form": "v4", "model": "annotator",
        "per_part": 800, "per_request": 15, "max_chars": 1500, "least_chars": 0, "in_flight": 10, "batch": 75, "pause": 3.0,
    }
    file = {}
    if "config" in given:
        import yaml

        with open(given["config"], encoding="utf-8") as f:
            file = {k.replace("-", "_"): v for k, v in (yaml.safe_load(f) or {}).items()}
    every = dict.fromkeys((*TEXT_OPTIONS, *NUMBER_OPTIONS))
    return argparse.Namespace(**(every | defaults | file | given))


def client(name: str | None, default):
    """The object that ``module:factory`` makes."""
    if not name:
        return default()
    module, factory = name.split(":")
    return getattr(importlib.import_module(module), factory)()


def report(a, line: str) -> None:
    """Progress on the standard output, and in the log file if there is one."""
    print(line)
    if a.log:
        os.makedirs(os.path.dirname(os.path.abspath(a.log)), exist_ok=True)
        with open(a.log, "a", encoding="utf-8") as f:
            f.write(line + "\n")


def days(spark: SparkSession, a, root: str) -> DataFrame:
    df = readers.read_days(spark, root, a.start, a.end)
    return readers.first_days(df, root, a.max_days) if a.max_days else df


def ingest(spark, a):
    began, read, kept = time.time(), Observation(), Observation()
    lines = readers.zstd_lines(spark, files.matching(spark, a.input)) if ".zst" in a.input else readers.text_lines(spark, a.input)
    if a.max_lines:
        lines = lines.limit(a.max_lines)
    records = readers.parse_records(lines.observe(read, F.count(F.lit(1)).alias("n")), a.kind, a.subreddits, a.drop_nsfw)
    sinks.write_days(records.observe(kept, F.count(F.lit(1)).alias("n")), a.output, a.force)
    report(a, f"DONE ({a.kind}) {os.path.basename(a.input)} in {time.time() - began:.1f}s lines={read.get['n']} kept={kept.get['n']}")


def clean_stage(spark, a):
    df = days(spark, a, a.input)
    out = clean.clean_submissions(df, a.window_seconds, a.drop_nsfw) if a.kind == "rs" else clean.clean_comments(df, a.window_seconds)
    sinks.write_days(out, a.output, a.force)


def prepare(spark, a):
    """Requests in the present form (a post with its comments), or in an earlier one (documents of a day in groups)."""
    posts = days(spark, a, a.input)
    if a.seeds:
        posts = requests.with_ids(posts, readers.read_ids(spark, a.seeds))
    prompt = "\n".join(r[0] for r in spark.read.text(a.prompt, wholetext=True).collect()) if a.prompt else ""
    if a.form == "v4":
        comments = requests.comments_of(readers.read_days(spark, a.comments), posts)
        made = requests.requests(posts, comments, prompt, a.model, a.per_request, a.max_chars)
    else:
        docs = requests.with_context(posts, readers.read_days(spark, a.posts)) if a.posts else posts
        grouped = requests.grouped_requests(docs, a.kind, a.form, prompt, a.model, a.per_request, a.max_chars, least_chars=a.least_chars)
        made = grouped.select(F.col("day").cast("string").alias("sid"), "chunk", F.unix_date("day").alias("created_utc"), F.array_repeat(F.lit(0), F.col("docs")).alias("items"), "custom_id", "line")
    rows = sinks.write_request_parts(made, a.output, a.per_part)
    sinks.write_manifest(spark, rows, f"{a.output}/manifest.json", kind=a.kind, start=a.start, end=a.end, per_request=a.per_request)
    report(a, f"DONE (prepare) parts={len(rows)} requests={sum(r['requests'] for r in rows)}")


def submit(spark, a):
    """Send the request files that have no result yet; results and error markers go to the output folder."""
    ended = annotate.collect(client(a.client, annotate.OfflineAnnotator), sorted(Path(a.input).glob("part-*.jsonl")), Path(a.output), a.in_flight, a.pause)
    report(a, f"DONE (submit) files={len(ended)} completed={sum(s == 'completed' for s in ended.values())}")


def parse(spark, a):
    docs, counted = days(spark, a, a.input), Observation()
    notes = replies.annotations(reply_lines(spark, a.replies), a.kind, version=a.form)
    annotated = replies.annotate(docs.withColumn("__day__", F.col("day")), notes, a.kind).observe(counted, *replies.counters())
    sinks.write_days(annotated, a.output, a.force)
    sinks.write_ids(replies.without_reply(docs, notes), f"{a.output}-failed")
    report(a, f"DONE (parse {a.kind}) docs={counted.get['docs']} with_tickers={counted.get['with_tickers']}")


def explode(spark, a):
    mentions = replies.explode_mentions(days(spark, a, a.input))
    if a.aliases:
        mentions = replies.apply_aliases(mentions, "symbol", readers.read_aliases(spark, a.aliases))
    sinks.write_days(mentions.withColumn("day", F.col("__day__")), a.output, a.force)


def daily_stage(spark, a):
    sinks.write_days(daily.daily_features(daily.usable_mentions(days(spark, a, a.input), "day")), a.output, a.force)


def _bars(spark, a, symbols: list[str]) -> tuple[DataFrame, list[str]]:
    """The bars of symbols from the first to the last wanted day; sources take the day after the last as their end."""
    import datetime as dt

    after = str(dt.date.fromisoformat(str(a.end)) + dt.timedelta(days=1))
    rows, missing = annotate.fetch_bars(client(a.client, annotate.NoPrices), symbols, str(a.start), after, a.batch, a.pause)
    names = [f.name for f in spark.createDataFrame([], BARS).schema]
    bars = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BARS)
    return bars.withColumn("symbol", symbol_key("symbol")).where(F.col("day").between(F.lit(str(a.start)).cast("date"), F.lit(str(a.end)).cast("date"))), missing


def fetch_prices(spark, a):
    """Bars with returns of all symbols of the daily features, and the list of those without any."""
    symbols = [r[0] for r in days(spark, a, a.input).select(symbol_key("symbol").alias("s")).where("s IS NOT NULL").distinct().toLocalIterator()]
    bars, missing = _bars(spark, a, symbols)
    sinks.write_days(market.with_returns(bars), a.output, a.force)
    sinks.write_symbols(spark.createDataFrame([(s,) for s in missing], "symbol string"), f"{a.output}-missing")
    report(a, f"DONE (fetch-prices) symbols={len(symbols)} missing={len(missing)}")


def refetch(spark, a):
    """Bars of listed symbols, under other names where an alias list has them, appended where they are not stored yet."""
    wanted = readers.read_symbols(spark, a.seeds)
    names = replies.apply_aliases(wanted.withColumn("asked", F.col("symbol")), "asked", readers.read_aliases(spark, a.aliases)) if a.aliases else wanted.withColumn("asked", F.col("symbol"))
    names = names.collect()  # a list that people keep
    bars, missing = _bars(spark, a, sorted({r["asked"] for r in names}))
    back = spark.createDataFrame([(r["asked"], r["symbol"]) for r in names], "asked string, name string")
    own = bars.join(F.broadcast(back), F.col("symbol") == F.col("asked")).withColumn("symbol", F.col("name")).drop("asked", "name")
    sinks.append_new(market.with_returns(own), a.output, ["symbol", "day"])
    report(a, f"DONE (refetch) symbols={len(names)} missing={len(missing)}")


def merge(spark, a):
    bars = readers.read_days(spark, a.prices, a.start, a.end)
    sinks.write_days(market.merge_features(days(spark, a, a.input), bars), a.output, a.force)


def enrich(spark, a):
    whole = market.enrich(readers.read_days(spark, a.input), scope=a.scope)  # windows need the days before the first one wanted
    if a.start:
        whole = whole.where(F.col("day") >= F.lit(a.start).cast("date"))
    if a.end:
        whole = whole.where(F.col("day") <= F.lit(a.end).cast("date"))
    sinks.write_days(whole, a.output, a.force)


STAGES = {
    "ingest": ingest, "clean": clean_stage, "prepare": prepare, "submit": submit, "parse": parse, "explode": explode, "daily": daily_stage,
    "fetch-prices": fetch_prices, "refetch": refetch, "merge": merge, "enrich": enrich,
}


def main(argv: list[str] | None = None) -> None:
    a = settings(sys.argv[1:] if argv is None else argv)
    spark = build_session(a.master)
    try:
        STAGES[a.stage](spark, a)
    finally:
        clean_up(spark)


if __name__ == "__main__":
    main()
