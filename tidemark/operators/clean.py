"""Cleaning of posts and comments: exact and near duplicates per day, spam flags, removed and empty texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, text


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order`` (nulls first): a minimum, combined before the shuffle; no sort of a group."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("__f"))
    return best.select(*(F.col(c) if c in keys else F.col(f"__f.`{c}`").alias(c) for c in df.columns))


def kept_rows(rows: Column, window_seconds: int) -> Column:
    """Of a sorted array of rows (__t, ...) those that start anew: each more than the window after the last one kept."""
    start = F.struct(F.lit(None).cast("bigint").alias("anchor"), F.slice(rows, 1, 0).alias("kept"))

    def step(acc: Column, row: Column) -> Column:
        fresh = acc["anchor"].isNull() | (row["__t"] - acc["anchor"] > window_seconds)
        return F.when(fresh, F.struct(row["__t"].alias("anchor"), F.concat(acc["kept"], F.array(row)).alias("kept"))).otherwise(acc)

    return F.aggregate(rows, start, step)["kept"]


def drop_near_duplicates(df: DataFrame, keys: Sequence[Column], day: str, seconds: str, row: str, window_seconds: int = 3600) -> DataFrame:
    """Rows of a day with equal keys count as repeats while they lie within the window of the last row kept.

    Missing times count as 0. Only the distinct seconds of a day and key are gathered, each with its smallest ``row``,
    which stays if the second does (at most 86,400 pairs, however many rows a hot key has).
    """
    marked = df.withColumns({f"__k{i}": k for i, k in enumerate(keys)}).withColumn("__t", F.coalesce(F.col(seconds).cast("bigint"), F.lit(0).cast("bigint")))
    group = [day, *(f"__k{i}" for i in range(len(keys)))]
    firsts = marked.groupBy(*group, "__t").agg(F.min(row).alias(row))
    gathered = firsts.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("__t", row))).alias("__rows"))
    stay = gathered.select(*group, F.explode(kept_rows(F.col("__rows"), window_seconds)).alias("__s")).select(*group, "__s.__t", F.col(f"__s.`{row}`").alias(row))
    return marked.join(stay, [*group, "__t", row], "left_semi").select(*df.columns)


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("created_utc", F.coalesce(F.col("created_utc").cast("bigint"), F.lit(0).cast("bigint"))).withColumn("day", coerce.epoch_day("created_utc"))


def clean_submissions(df: DataFrame, window_seconds: int = 3600, drop_nsfw: bool = True, keep_flagged: bool = False) -> DataFrame:
    """Deduplicated posts with spam flags and ``text``; flagged, adult and empty ones are dropped.

    Per day: the first row of an id, then the near-duplicates of (author, title). Null texts count as ''.
    """
    once = first_per_key(with_day(df), ["day", "id"], ["created_utc", "title", "author"])
    near = drop_near_duplicates(once, [F.lower(coerce.text_or_empty("author")), F.lower(coerce.text_or_empty("title"))], "day", "created_utc", "id", window_seconds)
    flags = text.spam_flags(F.col("title"), F.col("selftext"))
    out = near.withColumns(flags).withColumn("text", text.joined_text(F.col("title"), F.col("selftext")))
    if drop_nsfw:
        out = out.where(~F.coalesce("over_18", F.lit(False)))
    return out if keep_flagged else out.where(~_any(flags) & (F.length("text") > 0))


def clean_comments(df: DataFrame, window_seconds: int = 3600, keep_flagged: bool = False) -> DataFrame:
    """The same for comments: removed ones go first, near-duplicates are of (author, first 160 characters), capitals are no flag."""
    present = with_day(df).where(~text.is_gone(F.col("body")))
    once = first_per_key(present, ["day", "id"], ["created_utc", "body", "author"])
    seed = F.substring(F.lower(text.outer_strip(F.col("body"))), 1, 160)
    near = drop_near_duplicates(once, [F.lower(coerce.text_or_empty("author")), seed], "day", "created_utc", "id", window_seconds)
    flags = text.spam_flags(F.lit(None).cast("string"), F.col("body"))
    out = near.withColumns(flags).withColumn("text", F.coalesce("body", F.lit("")))
    return out if keep_flagged else out.where(~_any({k: v for k, v in flags.items() if k != "title_all_caps"}) & (F.length(text.squash(F.col("text"))) > 0))


def _any(flags: dict[str, Column]) -> Column:
    out = F.lit(False)
    for f in flags.values():
        out = out | f
    return out
