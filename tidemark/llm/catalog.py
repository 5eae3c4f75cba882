"""Queries p2 and p5 to p10 and the SQL of those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import strip, symbol_key, thread_key
from tidemark.llm import canonical, encode, history, leaks, nearest, quality, residue
from tidemark.session import Workspace, table

#: Where the vocabulary files of the public tokenizers are.
TOKENIZERS = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")
EPOCH = "CAST('1970-01-01' AS DATE)"


def _days(c: str):
    return F.expr(f"datediff({c}, {EPOCH})")


#: Blank, removed or deleted; the pattern gives up at the first character of any other text.
GONE = r"(?iU)^[\s\p{Z}\p{Cf}]*(?:\[(?:removed|deleted)\])?[\s\p{Z}\p{Cf}]*$"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """(kind, id, text) of each delivered submission and comment; removed and blank bodies have null texts."""
    gone = lambda c: F.coalesce(F.col(c).rlike(GONE), F.lit(True))
    title = F.coalesce("title", F.lit(""))
    posts = table(spark, d, "submissions").select(F.lit("submission").alias("kind"), "id", F.when(gone("selftext"), title).otherwise(F.concat(title, F.lit("\n\n"), "selftext")).alias("text"))
    replies = table(spark, d, "comments").select(F.lit("comment").alias("kind"), "id", F.when(~gone("body"), F.col("body")).alias("text"))
    return posts.unionByName(replies)


def p2_quality(spark: SparkSession, d: str) -> DataFrame:
    """(kind, id, statistics, label shares) of each delivered text."""
    return quality.text_quality(_texts(spark, d), F.col("text")).select("kind", "id", "quality.*")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """(kind, id) of the texts of 40 characters or more that are, by the greater part, no running prose."""
    judged = quality.text_quality(_texts(spark, d).where(F.length("text") >= 40), F.col("text"), counts=False)
    return judged.where("quality.prose < 0.5").where(F.length(strip("text")) >= 40).select("kind", "id").distinct()


def p2_statistics(spark: SparkSession, d: str) -> DataFrame:
    """(kind, id, chars, words, ...) of each delivered text: the statistics alone."""
    return p2_quality(spark, d).select("kind", "id", "chars", "words", *(F.round(c, 9).alias(c) for c in ("mean_word_length", "symbol_ratio", "closed_lines", "common_words"))).where("chars IS NOT NULL")


def p5_mapped(spark: SparkSession, d: str) -> DataFrame:
    """(mention_id, symbol, symbol_ref) of each mention; symbol_ref is '' where the value names no entry."""
    mentions = table(spark, d, "exploded").select("mention_id", "symbol")
    return canonical.map_column(mentions, "symbol", table(spark, d, "symbol_list"), "symbol", "name")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """(mention_id, symbol_ref) of the mentions whose symbol is no literal entry."""
    return p5_mapped(spark, d).where("symbol_ref IS NOT NULL AND symbol <> symbol_ref").select("mention_id", "symbol_ref")


def p6_nearest(spark: SparkSession, d: str) -> DataFrame:
    """(symbol, day, price_day) of each distinct symbol and day of reddit_daily; price_day is null if none is near."""
    left = table(spark, d, "reddit_daily").select("symbol", "day").distinct()
    prices = table(spark, d, "prices").where("Close IS NOT NULL")
    out = nearest.nearest(left, prices, "symbol", _days("day"), symbol_key("symbol"), _days("day"), 3)
    return out.select("symbol", "day", F.expr(f"date_add({EPOCH}, cast(nearest as int))").alias("price_day"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """(symbol, day, price_day) as strings, where the nearest price row lies on another day."""
    return p6_nearest(spark, d).where("price_day <> day").select("symbol", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("day", "price_day")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """(kind, id_a, id_b) of the records that repeat something accepted in an earlier batch."""
    part = lambda name, kind, text: table(spark, d, name).select(F.lit(kind).alias("kind"), thread_key("id").alias("key"), "id", text.cast("string").alias("text"), F.col("batch_no").cast("long").alias("batch"), F.col("arrived_at").alias("arrived"))
    records = part("submissions", "submission", F.lit(None)).unionByName(part("comments", "comment", F.col("body")))
    return history.repeated_records(records, Workspace(spark, "p7"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, ids) of each document by byte_bpe_50k."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return encode.encode_corpus(docs, "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken").select("doc_id", "ids")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, item_id) of the documents that carry passages of evaluation items."""
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "passage")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id) of the documents that are or contain page residue."""
    return residue.find_residue(table(spark, d, "documents"), "text", "source").select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_quality, p2_statistics, p5_found, p5_mapped, p6_found, p6_nearest, p7_found, p8_ids, p9_found, p10_found)}

_NEAREST = """days AS (SELECT DISTINCT symbol, day FROM reddit_daily),
  priced AS (SELECT DISTINCT upper(regexp_replace(symbol, '^\\s+|\\s+$', '', 'g')) AS symbol, day AS price_day FROM prices WHERE Close IS NOT NULL),
  ranked AS (SELECT d.symbol, d.day, p.price_day, row_number() OVER (PARTITION BY d.symbol, d.day ORDER BY abs(date_diff('day', d.day, p.price_day)), p.price_day) AS r
    FROM days d LEFT JOIN priced p ON p.symbol = d.symbol AND abs(date_diff('day', d.day, p.price_day)) <= 3)"""
_BLANK = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]"
_LETTERS = r"[\p{L}\p{Nl}\p{No}]"
_REST = rf"(?:{_BLANK}|\p{{Cf}})*"


def _gone(c: str) -> str:
    return rf"coalesce(regexp_matches({c}, '^{_REST}(?:\[(?i:removed|deleted)\])?{_REST}$'), true)"


_STATISTICS = rf"""WITH texts AS (
    SELECT 'submission' AS kind, id, CASE WHEN {_gone("selftext")} THEN coalesce(title, '') ELSE coalesce(title, '') || chr(10) || chr(10) || selftext END AS t FROM submissions
    UNION ALL SELECT 'comment', id, CASE WHEN NOT {_gone("body")} THEN body END FROM comments),
  parts AS (SELECT kind, id, t, regexp_extract_all(lower(t), '{_LETTERS}+(?:[''’]{_LETTERS}+)?') AS w, length(regexp_replace(t, '{_BLANK}', '', 'g')) AS solid, length(regexp_replace(t, '[^\p{{L}}\p{{N}}]', '', 'g')) AS plain,
      list_filter(regexp_split_to_array(t, '\r\n|[\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: NOT regexp_full_match(x, '{_BLANK}*')) AS l FROM texts WHERE t IS NOT NULL)
  SELECT kind, id, length(t)::INTEGER AS chars, len(w)::INTEGER AS words, round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x))) / len(w) ELSE 0 END, 9) AS mean_word_length,
    round(CASE WHEN solid > 0 THEN (solid - plain) / solid ELSE 0 END, 9) AS symbol_ratio,
    round(CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: regexp_matches(x, '[.!?…]["''”’)\]*]*{_BLANK}*$'))) / len(l) ELSE 0 END, 9) AS closed_lines,
    round(CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x IN ({", ".join(f"'{w}'" for w in sorted(quality.COMMON))}))) / len(w) ELSE 0 END, 9) AS common_words FROM parts"""
ORACLE = {
    "p2_statistics": _STATISTICS,
    "p6_found": f"WITH {_NEAREST} SELECT symbol, strftime(day, '%Y-%m-%d') AS day, strftime(price_day, '%Y-%m-%d') AS price_day FROM ranked WHERE r = 1 AND price_day <> day",
    "p6_nearest": f"WITH {_NEAREST} SELECT symbol, day, price_day FROM ranked WHERE r = 1",
}
