"""Sources: JSON lines (plain or zstd), day-partitioned tables, id lists, alias tables."""

from __future__ import annotations

import datetime as dt
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import coerce, text
from tidemark.session import ship
from tidemark.sources import files

SUBMISSION = "id string, created_utc bigint, subreddit string, title string, selftext string, score int, num_comments int, author string, permalink string, url string, over_18 boolean"
COMMENT = "id string, created_utc bigint, subreddit string, body string, score int, author string, parent_id string, link_id string, permalink string"
#: The communities kept by default (fixed values).
SUBREDDITS = ("stocks", "wallstreetbets", "investing", "trading", "stockmarket", "pennystocks")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of plain text files or those that Hadoop's codecs read."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def zstd_lines(spark: SparkSession, paths: Sequence[str], lines_per_batch: int = 50_000) -> DataFrame:
    """(file, line_no, line) of zstd files with windows up to 2 GiB, one task per file, bounded batches of lines.

    Undecodable bytes are replaced; the last line needs no line end.
    """
    ship(spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for batch in batches:
            for path in batch["path"]:
                with files.opened(path) as raw:
                    stream = io.TextIOWrapper(zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(raw, read_across_frames=True), encoding="utf-8", errors="replace", newline="\n")
                    held: list[str] = []
                    start = 0
                    for line in stream:
                        held.append(line.rstrip("\n"))
                        if len(held) == lines_per_batch:
                            yield pd.DataFrame({"file": path, "line_no": range(start, start + len(held)), "line": held})
                            start, held = start + len(held), []
                    if held:
                        yield pd.DataFrame({"file": path, "line_no": range(start, start + len(held)), "line": held})

    each = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return each.mapInPandas(read, "file string, line_no bigint, line string")


def parse_records(lines: DataFrame, kind: str, subreddits: Sequence[str] = SUBREDDITS, drop_nsfw: bool = False) -> DataFrame:
    """Typed records with ``day`` from raw lines: undecodable lines, other communities, rows without a time and removed
    comments are left out; nulls in text become '', numbers that do not parse 0."""
    wanted = SUBMISSION if kind == "rs" else COMMENT
    names = [f.strip().split(" ") for f in wanted.split(",")]
    v = lines.select(F.try_parse_json("line").alias("v")).where("v IS NOT NULL")
    raw = v.select(*(F.try_variant_get("v", f"$.{n}", "string").alias(n) for n, _ in names))
    kept = raw.where(F.lower("subreddit").isin(*(s.lower() for s in subreddits)) & F.col("created_utc").isNotNull())

    def typed(n: str, t: str):
        if t == "string":
            return coerce.text_or_empty(n)
        if t == "boolean":
            return coerce.flag(n)
        # a JSON number with a fraction is cut; text with one counts as unparseable
        return coerce.whole_number(n, t)

    out = kept.select(*(typed(n, t).alias(n) for n, t in names))
    if kind == "rs":
        out = out.where(~F.col("over_18")) if drop_nsfw else out
    else:
        out = out.where(~text.is_gone(F.col("body")))
    return out.withColumn("day", coerce.epoch_day("created_utc"))


def read_days(spark: SparkSession, root: str, start: dt.date | str | None = None, end: dt.date | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A table partitioned by day, or its days from start to end (both inclusive; only their folders are read); unreadable
    files are skipped (Spark logs a warning for each), columns that some files lack are null."""
    df = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(root)
    if start is not None:
        df = df.where(F.col("day") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col("day") <= F.lit(str(end)).cast("date"))
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns)) if columns else df


def first_days(df: DataFrame, root: str, most: int) -> DataFrame:
    """Of a table partitioned by day the first ``most`` days that are stored, told by their folders; the limit of trial runs."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    days = sorted(s.getPath().getName()[4:] for s in fs.listStatus(path) if s.getPath().getName().startswith("day="))
    return df.where(F.col("day").cast("string").isin(*days[:most]))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a text file: byte-order marks and outer blanks removed, blank lines dropped, each id once, in the order of the file."""
    ids = spark.read.text(path).select(F.trim(F.regexp_replace("value", "﻿", "")).alias("id"))
    first = ids.withColumn("n", F.monotonically_increasing_id()).where("id <> ''").groupBy("id").agg(F.min("n").alias("n"))
    return first.orderBy("n").select("id")


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(symbol) of a text list: the first word of each line without brackets, commas and quotes; comments are skipped."""
    first = F.upper(F.regexp_replace(F.element_at(F.split(F.trim("value"), r"\s+"), 1), r"[\[\],'\"]", ""))
    lines = spark.read.text(path).where(~F.trim("value").startswith("#")).select(first.alias("symbol"))
    return lines.where("symbol <> ''").distinct()


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(raw, normalized) of an alias file, upper case, blanks skipped, one row per raw form."""
    df = spark.read.option("header", "true").csv(path, schema="raw string, normalized string")
    up = df.select(*(F.upper(F.trim(c)).alias(c) for c in ("raw", "normalized"))).where("raw <> '' AND normalized <> ''")
    return up.withColumn("n", F.monotonically_increasing_id()).groupBy("raw").agg(F.max_by("normalized", "n").alias("normalized"))
