"""Queries of the text-signal pipeline over submissions, comments, exploded, reddit_daily and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import coerce, text
from tidemark.functions.keys import symbol_key, thread_key
from tidemark.operators import clean, daily, market, replies, requests
from tidemark.session import Workspace, table
from tidemark.sources import readers, sinks
from tidemark.sources.replies import reply_lines

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    return df.select(*((F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


# ---- mentions and daily features

_USABLE = """m AS (SELECT * FROM (
    SELECT id, upper(trim(symbol)) AS symbol, coalesce(CAST(make_timestamp(created_utc * 1000000) AS DATE), __day__) AS day, __day__ AS pday, sentiment_score,
      CASE WHEN conf IS NOT NULL THEN least(greatest(conf, 0), 1) END AS conf, is_forward, value_score,
      coalesce(score, 0)::DOUBLE AS score, coalesce(num_comments, 0)::DOUBLE AS num_comments, author, subreddit, asset_type
    FROM (SELECT * REPLACE (regexp_replace(symbol, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g') AS symbol) FROM exploded))
  WHERE symbol <> '' AND sentiment_score IS NOT NULL AND day = pday)"""
_DAILY = f"""{_USABLE},
  base AS (SELECT day, symbol, count(id) AS chatter_count, avg(sentiment_score) AS sent_mean, avg(conf) AS avg_conf, median(conf) AS median_conf,
      sum(score) AS score_sum, avg(score) AS score_mean, sum(num_comments) AS comments_sum, avg(num_comments) AS comments_mean, count(DISTINCT author) AS unique_authors,
      (count(*) FILTER (WHERE is_forward))::DOUBLE AS forward_true_count, count(is_forward)::DOUBLE AS forward_total, avg(value_score) AS value_mean, median(value_score) AS value_median,
      CASE WHEN sum(conf) > 0 THEN sum(sentiment_score * conf) / sum(conf) END AS sent_weighted FROM m GROUP BY day, symbol),
  modes AS (SELECT day, symbol, asset_type FROM (SELECT day, symbol, asset_type, row_number() OVER (PARTITION BY day, symbol ORDER BY count(*) DESC, asset_type) AS r
      FROM m WHERE asset_type IS NOT NULL GROUP BY day, symbol, asset_type) WHERE r = 1),
  entropies AS (SELECT day, symbol, -sum(p * log2(p)) + 0.0 AS subreddit_entropy FROM (SELECT day, symbol, count(*) / sum(count(*)) OVER (PARTITION BY day, symbol) AS p
      FROM m WHERE subreddit IS NOT NULL GROUP BY day, symbol, subreddit) GROUP BY day, symbol),
  features AS (SELECT *, forward_true_count / nullif(forward_total, 0) AS forward_share, score_sum + comments_sum AS engagement_sum, score_mean + comments_mean AS engagement_mean,
      unique_authors / nullif(chatter_count, 0) AS user_concentration FROM base LEFT JOIN modes USING (day, symbol) LEFT JOIN entropies USING (day, symbol))"""
_WIDE = ["sent_mean", "avg_conf", "median_conf", "score_sum", "score_mean", "comments_sum", "comments_mean", "forward_true_count", "forward_total", "value_mean", "value_median", "sent_weighted", "forward_share", "engagement_sum", "engagement_mean", "user_concentration", "subreddit_entropy"]


def _round(names: list[str], digits: int = 10) -> str:
    return ", ".join(f'round("{n}", {digits}) + 0.0 AS "{n}"' for n in names)


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return daily.usable_mentions(table(spark, d, "exploded"))


@query(f"WITH {_DAILY} SELECT day, symbol, chatter_count, unique_authors, asset_type, {_round(_WIDE)} FROM features")
def daily_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily.daily_features(_mentions(spark, d)))


def _feature_query(name: str, columns: list[str]) -> None:
    plain = [c for c in columns if c not in _WIDE]
    picked = ", ".join(["day", "symbol", *plain, _round([c for c in columns if c in _WIDE])] if any(c in _WIDE for c in columns) else ["day", "symbol", *plain])

    def run(spark: SparkSession, d: str) -> DataFrame:
        return rounded(daily.daily_features(_mentions(spark, d)).select("day", "symbol", *columns))

    run.__name__ = name
    QUERIES[name], ORACLE[name] = run, f"WITH {_DAILY} SELECT {picked} FROM features"


_feature_query("agg_weighted_mean", ["sent_mean", "sent_weighted"])
_feature_query("agg_median", ["median_conf", "value_median"])
_feature_query("agg_distinct", ["unique_authors"])
_feature_query("agg_conditional", ["forward_true_count", "forward_total"])
_feature_query("agg_ratio", ["forward_share", "user_concentration"])


@query(f"WITH {_DAILY} SELECT day, symbol, round(subreddit_entropy, 10) + 0.0 AS subreddit_entropy FROM entropies")
def agg_entropy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily.subreddit_entropy(_mentions(spark, d)))


@query(f"WITH {_DAILY} SELECT day, symbol, asset_type FROM modes")
def agg_mode(spark: SparkSession, d: str) -> DataFrame:
    return daily.dominant_asset(_mentions(spark, d))


# ---- prices, merge, windows

_BARS = """bars AS (SELECT symbol, day, "Open", "High", "Low", "Close", "Adj Close", "Volume" FROM (SELECT * REPLACE (upper(regexp_replace(symbol, '^\\s+|\\s+$', '', 'g')) AS symbol),
      row_number() OVER (PARTITION BY upper(regexp_replace(symbol, '^\\s+|\\s+$', '', 'g')), day ORDER BY "Close" DESC NULLS LAST, "Volume" DESC NULLS LAST, "Open" DESC NULLS LAST, "High" DESC NULLS LAST, "Low" DESC NULLS LAST, "Adj Close" DESC NULLS LAST) AS r
      FROM prices) WHERE r = 1),
  padded AS (SELECT *, last_value("Adj Close" IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY day ROWS UNBOUNDED PRECEDING) AS p FROM bars),
  rets AS (SELECT *, p / nullif(lag(p, 1) OVER w, 0) - 1 AS ret1, p / nullif(lag(p, 5) OVER w, 0) - 1 AS ret5 FROM padded WINDOW w AS (PARTITION BY symbol ORDER BY day)),
  priced AS (SELECT * EXCLUDE (p), CASE WHEN count(ret1) OVER r5 >= 3 THEN stddev_samp(ret1) OVER r5 END AS ret1_roll_std, CASE WHEN count("Volume") OVER r5 >= 3 THEN avg("Volume") OVER r5 END AS vol_roll_mean
      FROM rets WINDOW r5 AS (PARTITION BY symbol ORDER BY day ROWS 4 PRECEDING)),
  days AS (SELECT DISTINCT * FROM reddit_daily),
  merged AS (SELECT d.*, p.* EXCLUDE (symbol, day) FROM (SELECT * FROM days) d JOIN priced p ON upper(trim(d.symbol)) = p.symbol AND d.day = p.day)"""


def _bars(spark: SparkSession, d: str) -> DataFrame:
    return market.unique_bars(table(spark, d, "prices"))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    return market.merge_features(table(spark, d, "reddit_daily").dropDuplicates(), market.with_returns(_bars(spark, d)))


_PRICE = ["Open", "High", "Low", "Close", "Adj Close", "ret1", "ret5", "ret1_roll_std", "vol_roll_mean"]
_D8 = ["chatter_count", "unique_authors", "asset_type", "sent_mean", "avg_conf", "engagement_sum", "forward_share", "subreddit_entropy"]


@query(f'WITH {_BARS} SELECT symbol, day, "Volume", {_round(_PRICE)} FROM priced')
def win_pct_change(spark: SparkSession, d: str) -> DataFrame:
    return rounded(market.with_returns(_bars(spark, d)))


@query(f'WITH {_BARS} SELECT symbol, day, chatter_count, unique_authors, asset_type, "Volume", {_round(["sent_mean", "avg_conf", "engagement_sum", "forward_share", "subreddit_entropy", *_PRICE])} FROM merged')
def merge_inner(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_merged(spark, d).select("symbol", "day", *_D8, "Volume", *(F.col(f"`{c}`") for c in _PRICE)))


_W = "(PARTITION BY symbol ORDER BY day)"
_N = "(PARTITION BY symbol ORDER BY day ROWS {} PRECEDING)"


def _sql(name: str) -> str:
    """The SQL of an enrichment column, from its name."""
    base, _, tail = name.rpartition("_")
    if name == "Close_lag5":
        return f'lag("Close", 5) OVER {_W}'
    if tail.startswith("lag"):
        return f"lag({base}, {tail[3:]}) OVER {_W}"
    if name in market.DELTAS:
        c = market.DELTAS[name]
        return f"{c} - lag({c}, 1) OVER {_W}"
    if name == "intraday_range":
        return '("High" - "Low") / nullif("Close", 0)'
    if name == "momentum_5":
        return f'"Close" / nullif(lag("Close", 5) OVER {_W}, 0) - 1'
    if name.startswith("ret1_lead"):
        return f'"Adj Close" / nullif(lead("Adj Close", {name[9:]}) OVER {_W}, 0) - 1'
    if name.startswith("fwd_ret"):
        return f'lead("Adj Close", {name[7:]}) OVER {_W} / nullif("Adj Close", 0) - 1'
    if name.startswith("rel_volume_"):
        return f'"Volume" / nullif({_sql(f"vol_roll{tail}_mean")}, 0)'
    column, _, n = base.rpartition("_roll")
    f = {"sum": "sum", "mean": "avg", "std": "stddev_samp"}[tail]
    column = {"vol": '"Volume"'}.get(column, column)
    w = _N.format(int(n) - 1)
    value = f"{f}({column}) OVER {w}"
    return f"CASE WHEN count({column}) OVER {w} >= 3 THEN {value} END" if column in ("ret1", '"Volume"') else value


def _window_query(name: str, columns, whole: tuple[str, ...] = ()) -> None:
    """A query of enrichment columns; ``whole`` are those that stay whole numbers. ``columns`` is built when needed: windows need a session."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return rounded(_merged(spark, d).select("symbol", "day", *(c.alias(n) for n, c in columns().items())))

    run.__name__ = name
    QUERIES[name] = run


_LAGS = [f"{c}_lag{s}" for s in (1, 2, 3) for c in market.LAGGED]
_ROLLS = {label: [f"{c}_roll{n}_{label}" for n in (3, 7, 14, 30) for c in cols] for cols, label in ((market.SUMMED, "sum"), (market.AVERAGED, "mean"))}
_WINDOWS = {
    "win_lag": (lambda: market.lags(), _LAGS),
    "win_delta": (lambda: market.deltas(), list(market.DELTAS)),
    "win_roll_sum": (lambda: market.rolls(means=()), _ROLLS["sum"]),
    "win_roll_mean": (lambda: market.rolls(sums=()), _ROLLS["mean"]),
    "win_roll_std": (lambda: {k: v for k, v in market.market_rolls().items() if k.endswith("_std")}, [f"ret1_roll{n}_std" for n in (5, 14, 30)]),
    "win_rel_volume": (lambda: {k: v for k, v in market.market_rolls().items() if not k.endswith("_std")}, [x for n in (5, 20) for x in (f"vol_roll{n}_mean", f"rel_volume_{n}")]),
    "win_momentum": (lambda: market.momentum(), ["intraday_range", "Close_lag5", "momentum_5"]),
    "win_lead_target": (lambda: market.targets(), [f"{p}{h}" for p in ("ret1_lead", "fwd_ret") for h in (1, 2, 5)]),
}
_WHOLE = {"chatter_count", "unique_authors"}


def _is_whole(name: str) -> bool:
    return name == "delta_chatter" or name.startswith("chatter_count_roll") or name.rpartition("_lag")[0] in _WHOLE


def _picked(names: list[str]) -> str:
    return ", ".join(f"({_sql(n)})::BIGINT AS {n}" if _is_whole(n) else f"round({_sql(n)}, 10) + 0.0 AS {n}" for n in names)


for _name, (_columns, _names) in _WINDOWS.items():
    _window_query(_name, _columns)
    ORACLE[_name] = f"WITH {_BARS} SELECT symbol, day, {_picked(_names)} FROM merged"

_ALL = [n for _, names in _WINDOWS.values() for n in names]


@query(f'WITH {_BARS} SELECT symbol, day, chatter_count, round("Close", 10) + 0.0 AS "Close", {_picked(_ALL)} FROM merged')
def enrich_full(spark: SparkSession, d: str) -> DataFrame:
    """All features of the modelling table."""
    return rounded(market.enrich(_merged(spark, d)).select("symbol", "day", "chatter_count", "Close", *_ALL))


@query("""SELECT event_type AS symbol, CAST(ts AS DATE) AS day, round(arg_min(value, {'a': ts, 'b': event_id}), 10) AS "Open", round(max(value), 10) AS "High", round(min(value), 10) AS "Low",
    round(arg_max(value, {'a': ts, 'b': event_id}), 10) AS "Close", count(value) AS "Volume" FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def ohlc_from_ticks(spark: SparkSession, d: str) -> DataFrame:
    return rounded(market.bars_from_ticks(table(spark, d, "events"), "event_type", "ts", "value", "event_id"))


# ---- cleaning

_SQUASH = "trim(regexp_replace(coalesce({}, ''), '\\s+', ' ', 'g'))"
_STRIP = "regexp_replace(coalesce({}, ''), '^\\s+|\\s+$', '', 'g')"


def _texts_sql(source: str, title: str, body: str) -> str:
    """``source`` with the squashed title, body and both as t_, b_ and both_."""
    return f"(SELECT *, trim(t_ || ' ' || b_) AS both_ FROM (SELECT *, {_SQUASH.format(title)} AS t_, {_SQUASH.format(body)} AS b_ FROM {source}))"


_FLAGS = """length(t_) = 0 AND length(b_) = 0 AS is_empty_text,
      len(list_filter(range(1, length(both_) - 3), lambda i: substr(both_, i, 5) = repeat(substr(both_, i, 1), 5))) > 0 AS has_repeat,
      length(both_) >= 40 AND 1.0 - (length(both_) - length(regexp_replace(both_, '[A-Za-z0-9]+', '', 'g')))::DOUBLE / greatest(length(both_), 1) > 0.55 AS too_many_symbols,
      length(t_) >= 8 AND upper(t_) = t_ AND regexp_matches(t_, '\\p{L}') AS title_all_caps,
      length(b_) >= 8 AND (length(b_) - length(regexp_replace(b_, 'https?://\\S+', '', 'g')))::DOUBLE / greatest(length(b_), 1) > 0.7 AS body_mostly_urls"""


@query(f"SELECT id, batch_no, {_FLAGS} FROM {_texts_sql('submissions', 'title', 'selftext')}")
def spam_flags(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "submissions")
    return s.select("id", "batch_no", *(c.alias(n) for n, c in text.spam_flags(F.col("title"), F.col("selftext")).items()))


@query(f"SELECT id, batch_no, {_SQUASH.format('selftext')} AS squashed, lower({_STRIP.format('title')}) AS lowered, substr({_STRIP.format('title')}, 1, 160) AS head, length(title) AS n FROM submissions")
def text_normalize(spark: SparkSession, d: str) -> DataFrame:
    t = text.outer_strip(F.col("title"))
    return table(spark, d, "submissions").select("id", "batch_no", text.squash(F.col("selftext")).alias("squashed"), F.lower(t).alias("lowered"), F.substring(t, 1, 160).alias("head"), F.length("title").cast("long").alias("n"))


def _clean_sql(kind: str) -> str:
    """(flagged) rows after both deduplications, per day."""
    post = kind == "submissions"
    body, seed = ("selftext", "lower(coalesce(title, ''))") if post else ("body", f"substr(lower({_STRIP.format('body')}), 1, 160)")
    src = "submissions" if post else f"comments WHERE lower({_STRIP.format('body')}) NOT IN ('', '[deleted]', '[removed]')"
    second = "title" if post else "body"
    return f"""dated AS (SELECT * REPLACE (coalesce(created_utc, 0) AS created_utc), CAST(make_timestamp(coalesce(created_utc, 0) * 1000000) AS DATE) AS day FROM {src}),
  firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY day, id ORDER BY created_utc, {second} NULLS FIRST, author NULLS FIRST, {'selftext NULLS FIRST, score NULLS FIRST' if post else 'score NULLS FIRST'}) AS rn FROM dated) WHERE rn = 1),
  keyed AS (SELECT *, lower(coalesce(author, '')) AS k1, {seed} AS k2 FROM firsts),
  seconds AS (SELECT day, k1, k2, created_utc AS t, min(id) AS id FROM keyed GROUP BY ALL),
  folded AS (SELECT day, k1, k2, list_reduce(list_sort(list(t)), lambda acc, x: CASE WHEN x[1] - acc[-1] > 3600 THEN list_concat(acc, x) ELSE acc END) AS kept
     FROM (SELECT day, k1, k2, [t] AS t FROM seconds) GROUP BY ALL),
  stay AS (SELECT s.id, s.day FROM seconds s JOIN folded f USING (day, k1, k2) WHERE list_contains(f.kept, s.t)),
  near AS (SELECT k.* FROM keyed k JOIN stay USING (id, day)),
  flagged AS (SELECT id, day, author, subreddit, score, {'over_18, num_comments, ' if post else 'link_id, parent_id, '}created_utc, {_FLAGS},
     {f"regexp_replace(coalesce(title, '') || chr(10) || chr(10) || coalesce(selftext, ''), '^" + chr(92) + "s+|" + chr(92) + "s+$', '', 'g')" if post else "coalesce(body, '')"} AS text FROM {_texts_sql('near', 'title' if post else "''", body)})"""


_CLEAN_RS = f"{_clean_sql('submissions')}, clean AS (SELECT * FROM flagged WHERE NOT coalesce(over_18, false) AND NOT (is_empty_text OR has_repeat OR too_many_symbols OR title_all_caps OR body_mostly_urls) AND length(text) > 0)"
_CLEAN_RC = f"{_clean_sql('comments')}, clean AS (SELECT * FROM flagged WHERE NOT (is_empty_text OR has_repeat OR too_many_symbols OR body_mostly_urls) AND length(text) > 0)"


@query(f"WITH {_CLEAN_RS} SELECT id, day, text FROM clean")
def spam_filter(spark: SparkSession, d: str) -> DataFrame:
    """The whole cleaning of submissions."""
    return clean.clean_submissions(table(spark, d, "submissions")).select("id", "day", "text")


@query(f"WITH {_CLEAN_RC} SELECT id, day, text FROM clean")
def clean_comments(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_comments(table(spark, d, "comments")).select("id", "day", "text")


@query(f"WITH {_clean_sql('comments')} SELECT id, day FROM near")
def near_dup_greedy(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_comments(table(spark, d, "comments"), keep_flagged=True).select("id", "day")


@query(f"WITH {_clean_sql('submissions')} SELECT id, day, created_utc, title FROM firsts")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    return clean.first_per_key(clean.with_day(table(spark, d, "submissions")), ["day", "id"], ["created_utc", "title", "author"]).select("id", "day", "created_utc", "title")


@query("SELECT count(*) AS lines, count(*) FILTER (WHERE lower(regexp_replace(coalesce(body, ''), '^\\s+|\\s+$', '', 'g')) IN ('', '[deleted]', '[removed]')) AS removed, count(DISTINCT id) AS ids, count(*) FILTER (WHERE author IS NULL) AS without_author FROM comments")
def qa_counters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "comments").agg(F.count(F.lit(1)).alias("lines"), F.count_if(text.is_gone(F.col("body"))).alias("removed"), F.countDistinct("id").alias("ids"), F.count_if(F.col("author").isNull()).alias("without_author"))


# ---- filters, scans, set operations


@query("SELECT id, batch_no, arrived_at, subreddit FROM submissions WHERE lower(subreddit) IN ('stocks', 'wallstreetbets', 'investing', 'trading', 'stockmarket', 'pennystocks')")
def filter_isin_ci(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "submissions").where(F.lower("subreddit").isin(*readers.SUBREDDITS)).select("id", "batch_no", "arrived_at", "subreddit")


@query("SELECT id, batch_no, arrived_at, over_18 FROM submissions WHERE NOT coalesce(over_18, false)")
def filter_bool_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "submissions").where(~F.coalesce("over_18", F.lit(False))).select("id", "batch_no", "arrived_at", "over_18")


@query(f"SELECT id, batch_no, arrived_at FROM comments WHERE lower({_STRIP.format('body')}) NOT IN ('', '[deleted]', '[removed]')")
def filter_deleted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "comments").where(~text.is_gone(F.col("body"))).select("id", "batch_no", "arrived_at")


@query(f"SELECT id, batch_no, arrived_at, {_STRIP.format('substr(body, 1, 1500)')} AS text FROM comments WHERE length({_STRIP.format('substr(body, 1, 1500)')}) >= 20")
def filter_min_len(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "comments").select("id", "batch_no", "arrived_at", text.clipped(F.col("body"), 1500).alias("text")).where(F.length("text") >= 20)


def _by_day(spark: SparkSession, d: str, name: str, day: str = "day") -> str:
    """A table written by day to the shared folder, to be read as the stages read theirs."""
    root = Workspace(spark, "days").path(name)
    sinks.write_days(table(spark, d, name).withColumn("day", F.col(day)).where("day IS NOT NULL"), root)
    return root


@query("SELECT strftime(__day__, '%Y-%m') AS month, count(*) AS n, count(DISTINCT symbol) AS symbols, count(DISTINCT __day__) AS days FROM exploded WHERE __day__ IS NOT NULL GROUP BY 1")
def scan_partitions(spark: SparkSession, d: str) -> DataFrame:
    """All parts of all stored days; the days are told by their folders."""
    root = _by_day(spark, d, "exploded", "__day__")
    months = spark.createDataFrame([(x,) for x in sorted(sinks.stored_days(spark, root))], "day string").groupBy(F.substring("day", 1, 7).alias("month")).agg(F.count("day").alias("days"))
    rows = readers.read_days(spark, root).groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("symbols"))
    return rows.join(F.broadcast(months), "month")


@query("SELECT symbol, day, chatter_count FROM reddit_daily WHERE day BETWEEN DATE '2025-07-01' AND DATE '2025-07-15'")
def scan_date_range(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_days(spark, _by_day(spark, d, "reddit_daily"), "2025-07-01", "2025-07-15", ["symbol", "day", "chatter_count"])


@query("SELECT symbol, day, chatter_count FROM reddit_daily WHERE day = DATE '2025-07-07'")
def scan_day(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_days(spark, _by_day(spark, d, "reddit_daily"), "2025-07-07", "2025-07-07", ["symbol", "day", "chatter_count"])


@query("SELECT symbol, count(*) AS n, sum(engagement_sum) AS engagement, NULL::VARCHAR AS absent FROM reddit_daily WHERE day IS NOT NULL GROUP BY symbol")
def scan_projection(spark: SparkSession, d: str) -> DataFrame:
    """Two columns of a stored table, and one that it lacks."""
    few = readers.read_days(spark, _by_day(spark, d, "reddit_daily"), columns=["symbol", "engagement_sum", "absent"])
    return few.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("engagement_sum").alias("engagement"), F.max(F.col("absent").cast("string")).alias("absent"))


@query("SELECT symbol, day, chatter_count FROM (SELECT DISTINCT symbol, day, chatter_count FROM reddit_daily) ORDER BY chatter_count DESC, symbol, day LIMIT 100")
def sort_limit(spark: SparkSession, d: str) -> DataFrame:
    """The 100 busiest symbol days: here the limit is the feature."""
    return table(spark, d, "reddit_daily").select("symbol", "day", "chatter_count").distinct().orderBy(F.desc("chatter_count"), "symbol", "day").limit(100)


@query("SELECT day, count(*) AS n FROM reddit_daily WHERE day IN (SELECT DISTINCT day FROM reddit_daily ORDER BY day LIMIT 5) GROUP BY day")
def limit_smoke(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the first five stored days (the limit of trial runs)."""
    root = _by_day(spark, d, "reddit_daily")
    return readers.first_days(readers.read_days(spark, root), root, 5).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


_SYMBOL = "nullif(upper(regexp_replace(symbol, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')), '')"


@query(f"SELECT DISTINCT symbol FROM (SELECT {_SYMBOL} AS symbol FROM exploded UNION ALL SELECT {_SYMBOL} FROM reddit_daily) WHERE symbol IS NOT NULL")
def distinct_symbols(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "exploded").select(symbol_key("symbol").alias("symbol")).union(table(spark, d, "reddit_daily").select(symbol_key("symbol"))).where("symbol IS NOT NULL").distinct()


@query(f"SELECT {_SYMBOL} AS symbol FROM reddit_daily EXCEPT SELECT {_SYMBOL} FROM prices")
def missing_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Symbols without a price, written as a list and read back."""
    missing = table(spark, d, "reddit_daily").select(symbol_key("symbol").alias("symbol")).subtract(table(spark, d, "prices").select(symbol_key("symbol")))
    at = Workspace(spark, "lists").path("missing")
    sinks.write_symbols(missing, at)
    return readers.read_symbols(spark, at)


@query("SELECT id, subreddit, score, num_comments, NULL::VARCHAR AS link_id, batch_no FROM submissions UNION ALL SELECT id, subreddit, score, NULL, link_id, batch_no FROM comments")
def union_missing_cols(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "submissions").select("id", "subreddit", "score", "num_comments", "batch_no").unionByName(table(spark, d, "comments").select("id", "subreddit", "score", "link_id", "batch_no"), allowMissingColumns=True)


# ---- joins

_BARE = r"nullif(regexp_replace(regexp_replace(lower({}), '^\s+|\s+$', '', 'g'), '^t[13]_', ''), '')"


@query(f"SELECT id, batch_no, arrived_at, link_id FROM comments WHERE {_BARE.format('link_id')} IN (SELECT {_BARE.format('id')} FROM submissions WHERE score >= 10)")
def comments_semi(spark: SparkSession, d: str) -> DataFrame:
    return requests.comments_of(table(spark, d, "comments"), table(spark, d, "submissions").where("score >= 10")).select("id", "batch_no", "arrived_at", "link_id")


@query("SELECT id, batch_no, arrived_at FROM submissions WHERE id IN (SELECT submission_id FROM exploded WHERE conf > 0.9)")
def seed_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """The submissions that a list of ids names, the list written and read back."""
    at = Workspace(spark, "lists").path("seeds")
    table(spark, d, "exploded").where("conf > 0.9 AND submission_id IS NOT NULL").select(F.col("submission_id")).write.text(at)
    return requests.with_ids(table(spark, d, "submissions"), readers.read_ids(spark, at)).select("id", "batch_no", "arrived_at")


@query("SELECT DISTINCT id FROM comments WHERE id NOT IN (SELECT id FROM exploded WHERE kind = 'comment')")
def failed_anti(spark: SparkSession, d: str) -> DataFrame:
    return replies.without_reply(table(spark, d, "comments").select("id").distinct(), table(spark, d, "exploded").where("kind = 'comment'"))


@query("SELECT DISTINCT symbol, day FROM reddit_daily r WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE upper(regexp_replace(p.symbol, '^\\s+|\\s+$', '', 'g')) = r.symbol AND p.day = r.day)")
def refetch_anti(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "prices").select(symbol_key("symbol").alias("symbol"), "day")
    return table(spark, d, "reddit_daily").select("symbol", "day").distinct().join(stored, ["symbol", "day"], "left_anti")


@query("SELECT id, batch_no, arrived_at FROM comments WHERE id IN (SELECT id FROM exploded WHERE kind = 'comment')")
def parse_rc_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "comments").join(table(spark, d, "exploded").where("kind = 'comment'").select("id"), "id", "left_semi").select("id", "batch_no", "arrived_at")


@query("""WITH docs AS (SELECT id, min(created_utc) AS created_utc, max(score) AS score, max(num_comments) AS num_comments, min(subreddit) AS subreddit, min(author) AS author FROM submissions GROUP BY id)
    SELECT mention_id, coalesce(e.subreddit, d.subreddit) AS subreddit, d.created_utc, d.score, d.num_comments, coalesce(e.author, d.author) AS author FROM exploded e LEFT JOIN docs d ON e.id = d.id""")
def join_left_m1(spark: SparkSession, d: str) -> DataFrame:
    """Mentions with the fields of their posts, as the first version of the daily table joined them."""
    docs = table(spark, d, "submissions").groupBy("id").agg(F.min("created_utc").alias("created_utc"), F.max("score").alias("score"), F.max("num_comments").alias("num_comments"), F.min("subreddit").alias("subreddit"), F.min("author").alias("author"))
    mentions = table(spark, d, "exploded").select("mention_id", "id", "subreddit", "author")
    return daily.with_document_fields(mentions, docs).drop("id")


@query("""SELECT mention_id, coalesce(l.symbol, e.symbol) AS symbol FROM exploded e LEFT JOIN symbol_list l ON upper(trim(e.symbol)) = upper(trim(l.name))""")
def alias_join(spark: SparkSession, d: str) -> DataFrame:
    """Symbols under their canonical names, by an alias file written and read back."""
    at = Workspace(spark, "lists").path("aliases")
    table(spark, d, "symbol_list").select(F.col("name").alias("raw"), F.col("symbol").alias("normalized")).write.option("header", "true").csv(at)
    return replies.apply_aliases(table(spark, d, "exploded").select("mention_id", "symbol"), "symbol", readers.read_aliases(spark, at))


# ---- requests


def _threads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return clean.clean_submissions(table(spark, d, "submissions")), clean.clean_comments(table(spark, d, "comments"))


_THREADS = f"""{_CLEAN_RS.replace('flagged', 'rs_flagged').replace('dated', 'rs_dated').replace('firsts', 'rs_firsts').replace('keyed', 'rs_keyed').replace('seconds', 'rs_seconds').replace('folded', 'rs_folded').replace('stay', 'rs_stay').replace('near', 'rs_near').replace('clean', 'rs')},
  {_CLEAN_RC.replace('clean', 'rc')},
  posts AS (SELECT id AS sid, {_BARE.format('id')} AS k, created_utc AS made, {_STRIP.format('substr(text, 1, 1500)')} AS post FROM rs WHERE {_STRIP.format('substr(text, 1, 1500)')} <> ''),
  chunks AS (SELECT l, (rn - 1) // 15 AS chunk, count(*) AS n, string_agg(id, ',' ORDER BY rn) AS ids FROM (SELECT {_BARE.format('link_id')} AS l, id, row_number() OVER (PARTITION BY {_BARE.format('link_id')} ORDER BY created_utc, id) AS rn FROM rc) GROUP BY ALL),
  reqs AS (SELECT sid, made, coalesce(chunk, 0) AS chunk, coalesce(n, 0) + 1 AS docs, coalesce(ids, '') AS ids FROM posts LEFT JOIN chunks ON k = l)"""


@query(f"WITH {_THREADS} SELECT sid, chunk::INTEGER AS chunk, docs::INTEGER AS docs, format('sub:{{}}:{{:04d}}', sid, chunk) AS custom_id, ids AS comment_ids FROM reqs")
def context_group(spark: SparkSession, d: str) -> DataFrame:
    """One row per request: the post, the chunk, its items and the comments in their order."""
    r = requests.requests(*_threads(spark, d))
    ids = F.array_join(F.transform(F.filter("items", lambda x: F.get_json_object(x, "$.kind") == "comment"), lambda x: F.get_json_object(x, "$.comment_id")), ",")
    return r.select("sid", "chunk", F.size("items").alias("docs"), "custom_id", ids.alias("comment_ids"))


@query(f"WITH {_THREADS} SELECT part, count(*) AS requests, sum(docs)::BIGINT AS docs FROM (SELECT *, (row_number() OVER (ORDER BY made, sid, chunk) - 1) // 100 AS part FROM reqs) GROUP BY part")
def request_manifest(spark: SparkSession, d: str) -> DataFrame:
    return requests.manifest(requests.requests(*_threads(spark, d)), per_part=100)


@query(f"WITH {_THREADS} SELECT c.id, c.day, coalesce(p.text, '') AS context FROM rc c LEFT JOIN rs p ON p.day = c.day AND {_BARE.format('p.id')} = {_BARE.format('c.link_id')}")
def context_left(spark: SparkSession, d: str) -> DataFrame:
    posts, comments = _threads(spark, d)
    return requests.with_context(comments, posts).select("id", "day", "context")


@query("SELECT l_orderkey, l_linenumber, l_partkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1)::INTEGER AS pos, ((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 3)::INTEGER AS chunk FROM lineitem")
def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    return requests.numbered(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 3).select("l_orderkey", "l_linenumber", "l_partkey", "pos", "chunk")


# ---- ingest and replies


def _reply_lines(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Mentions rendered as reply files, one line per mention (so that the last line of a document wins), and read again."""
    m = table(spark, d, "exploded").where(F.col("kind") == kind)
    key = "submission_id" if kind == "submission" else "comment_id"
    item = F.struct(
        F.col("id").alias(key), "is_forward", "value_score",
        F.array(F.struct("symbol", "asset_type", F.col("sentiment_label").alias("label"), F.col("sentiment_score").cast("string").alias("score"), "conf")).alias("tickers"),
    )
    content = F.array(F.struct(F.to_json(F.struct(F.array(item).alias("results"))).alias("text")))
    body = F.struct(F.lit("completed").alias("status"), F.array(F.struct(content.alias("content"))).alias("output"))
    lines = m.select("mention_id", F.to_json(F.struct(F.struct(body.alias("body")).alias("response"))).alias("line"))
    at = Workspace(spark, "replies").path(kind)
    sinks.write_parts(lines, ["mention_id"], at, 20_000)
    return reply_lines(spark, at)



def _notes(kind: str) -> str:
    return f"""notes AS (SELECT * FROM (SELECT id, mention_id, {_SYMBOL} AS symbol, asset_type, sentiment_label, sentiment_score, conf, is_forward, value_score,
    row_number() OVER (PARTITION BY id ORDER BY mention_id DESC) AS r FROM exploded WHERE kind = '{kind}') WHERE r = 1)"""


_LABEL = """CASE WHEN lower(trim(sentiment_label)) IN ('positive', 'negative', 'neutral') THEN lower(trim(sentiment_label)) WHEN lower(trim(sentiment_label)) = 'bullish' THEN 'positive'
    WHEN lower(trim(sentiment_label)) = 'bearish' THEN 'negative' WHEN sentiment_label IS NOT NULL THEN 'neutral' END"""
_ASSET = "CASE WHEN lower(trim(asset_type)) IN ('equity', 'etf', 'reit', 'index', 'commodity', 'fx', 'crypto', 'bond', 'other') THEN lower(trim(asset_type)) WHEN asset_type IS NOT NULL THEN 'other' END"


@query(f"WITH {_notes('comment')} SELECT id, symbol, {_ASSET} AS asset_type, {_LABEL} AS sentiment_label, round(sentiment_score, 10) AS sentiment_score, round(conf, 10) AS conf, is_forward, round(value_score, 10) AS value_score FROM notes WHERE symbol IS NOT NULL")
def parse_replies(spark: SparkSession, d: str) -> DataFrame:
    notes = replies.annotations(_reply_lines(spark, d, "comment"), "rc")
    return rounded(notes.select("id", F.explode("ticker_items").alias("t"), "is_forward", "value_score").select("id", "t.*", "is_forward", "value_score"))


@query(f"WITH {_notes('submission')} SELECT id, (symbol IS NOT NULL)::INTEGER AS tickers, is_forward, round(value_score, 10) AS value_score FROM notes")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    notes = replies.annotations(_reply_lines(spark, d, "submission"), "rs")
    return rounded(notes.select("id", F.size("ticker_items").alias("tickers"), "is_forward", "value_score"))


@query(f"SELECT mention_id, {_LABEL} AS sentiment_label, {_ASSET} AS asset_type, CASE WHEN conf IS NOT NULL THEN least(greatest(conf, 0), 1) END AS conf FROM exploded")
def label_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "exploded").select("mention_id", coerce.sentiment_label("sentiment_label").alias("sentiment_label"), coerce.asset_type("asset_type").alias("asset_type"), coerce.unit_interval("conf").alias("conf"))


@query(f"WITH {_CLEAN_RC}, {_notes('comment')} SELECT c.id, 'comment' AS kind, n.symbol, {_LABEL} AS sentiment_label, n.is_forward, c.author, c.created_utc FROM clean c JOIN notes n USING (id) WHERE n.symbol IS NOT NULL")
def explode_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned comments with their parsed annotations, one row per mention."""
    notes = replies.annotations(_reply_lines(spark, d, "comment"), "rc")
    annotated = replies.annotate(clean.clean_comments(table(spark, d, "comments")), notes, "rc")
    return replies.explode_mentions(annotated).select("id", "kind", "symbol", "sentiment_label", "is_forward", "author", "created_utc")


@query("""SELECT id, created_utc, coalesce(title, '') AS title, coalesce(selftext, '') AS selftext, coalesce(score, 0)::INTEGER AS score, coalesce(over_18, false) AS over_18, CAST(make_timestamp(created_utc * 1000000) AS DATE) AS day
    FROM submissions WHERE lower(subreddit) IN ('stocks', 'wallstreetbets', 'investing', 'trading', 'stockmarket', 'pennystocks')""")
def ingest_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Submissions written as raw JSON lines and ingested again."""
    s = table(spark, d, "submissions").drop("batch_no", "arrived_at")
    at = Workspace(spark, "raw").path("rs")
    s.select(F.to_json(F.struct(*s.columns)).alias("value")).write.text(at)
    return readers.parse_records(readers.text_lines(spark, at), "rs").select("id", "created_utc", "title", "selftext", "score", "over_18", "day")


# ---- earlier versions of requests, replies and features


_CONTEXT = f"ctx AS (SELECT c.id, c.day, c.created_utc, c.text, coalesce(p.text, '') AS context FROM rc c LEFT JOIN rs p ON p.day = c.day AND {_BARE.format('p.id')} = {_BARE.format('c.link_id')})"


@query(f"""WITH {_THREADS}, {_CONTEXT} SELECT day, chunk, count(*)::INTEGER AS docs, format('rc:{{}}:{{}}:{{:04d}}', day, arg_min(id, rn), chunk) AS custom_id, string_agg(id, ',' ORDER BY rn) AS ids
    FROM (SELECT *, ((rn - 1) // 16)::INTEGER AS chunk FROM (SELECT day, id, row_number() OVER (PARTITION BY day ORDER BY created_utc, id) AS rn FROM ctx WHERE length({_STRIP.format('substr(text, 1, 1500)')}) >= 5)) GROUP BY day, chunk""")
def request_groups(spark: SparkSession, d: str) -> DataFrame:
    """Comments of a day with their posts' texts, sixteen to a request."""
    posts, comments = _threads(spark, d)
    r = requests.grouped_requests(requests.with_context(comments, posts), "rc", "v3", least_chars=5)
    lines = F.split(F.element_at(F.split(F.get_json_object("line", "$.body.input[1].content"), "BEGIN_INPUTS:\n", 2), 2), "\n")
    return r.select("day", "chunk", "docs", "custom_id", F.array_join(F.transform(lines, lambda x: F.get_json_object(x, "$.comment_id")), ",").alias("ids"))


@query(f"WITH {_notes('comment')} SELECT id, symbol, {_LABEL} AS sentiment_label, round(sentiment_score, 10) AS sentiment_score, coalesce(is_forward, false) AS forward FROM notes WHERE symbol IS NOT NULL")
def parse_replies_earlier(spark: SparkSession, d: str) -> DataFrame:
    """Replies in the third dialect: comments by comment_id, no asset types."""
    notes = replies.annotations(_reply_lines(spark, d, "comment"), "rc", version="v3")
    return rounded(notes.select("id", F.explode("ticker_items").alias("t"), F.coalesce("is_forward", F.lit(False)).alias("forward")).select("id", "t.symbol", "t.sentiment_label", "t.sentiment_score", "forward"))


@query(f"WITH {_DAILY} SELECT day, symbol, chatter_count, unique_authors, {_round([c for c in daily.FIRST_VERSION if c in _WIDE])} FROM features")
def daily_features_first(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily.daily_features(_mentions(spark, d)).select(*daily.FIRST_VERSION))


@query("SELECT day, symbol, field, round(value, 10) AS value FROM (UNPIVOT (SELECT day, symbol, \"Open\", \"High\", \"Low\", \"Close\" FROM prices) ON \"Open\", \"High\", \"Low\", \"Close\" INTO NAME field VALUE value) WHERE value IS NOT NULL")
def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    """Price columns, named as sources name theirs, as rows; the place of the day is taken by the day and symbol."""
    fields = ["Open", "High", "Low", "Close"]
    wide = table(spark, d, "prices").select(F.struct("day", "symbol").alias("key"), *(F.col(c).alias(f"{c}|value") for c in fields))
    rows = market.wide_to_long(wide, "key", fields, ["value"])
    return rounded(rows.select("day.day", "day.symbol", F.col("symbol").alias("field"), "value"))


@query(f"""WITH {_notes("comment")} SELECT count(*) AS docs, count(*) FILTER (WHERE n.symbol IS NOT NULL) AS with_tickers FROM (SELECT DISTINCT id FROM comments) c JOIN notes n USING (id)""")
def qa_tickers(spark: SparkSession, d: str) -> DataFrame:
    """How many comments have an annotation, and how many of these name a ticker."""
    notes = replies.annotations(_reply_lines(spark, d, "comment"), "rc")
    return replies.annotate(table(spark, d, "comments").select("id").distinct(), notes, "rc").agg(*replies.counters())
