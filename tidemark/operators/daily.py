"""Daily features per symbol from mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce
from tidemark.functions.keys import symbol_key
from tidemark.operators.market import require_unique

KEY = ["day", "symbol"]


def usable_mentions(df: DataFrame, partition_day: str = "__day__") -> DataFrame:
    """Mentions with a symbol and a sentiment whose day is the day of their partition; a missing time is that day."""
    return (
        df.withColumn("symbol", symbol_key("symbol"))
        .withColumn("__partition", F.col(partition_day))  # which may be ``day`` itself
        .withColumn("day", F.coalesce(coerce.epoch_day(F.col("created_utc").cast("bigint")), F.col("__partition")))
        .where(F.col("symbol").isNotNull() & F.col("sentiment_score").isNotNull() & (F.col("day") == F.col("__partition")))
        .drop("__partition")
        .withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
        .withColumn("num_comments", F.coalesce(F.col("num_comments").cast("double"), F.lit(0.0)))
        .withColumn("conf", coerce.unit_interval("conf"))
    )


def with_document_fields(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Mentions with the fields of their annotated document (id unique, else reading fails), as the first version joined
    them: a field that both have is taken from the mention, and from the document where that is null."""
    taken = [c for c in ("created_utc", "score", "num_comments", "subreddit", "author") if c in documents.columns]
    d = require_unique(documents.select("id", *taken), ["id"]).select("id", *(F.col(c).alias(f"__{c}") for c in taken))
    joined = mentions.join(d, "id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) if c in mentions.columns else F.col(f"__{c}") for c in taken}).drop(*(f"__{c}" for c in taken))


def dominant_asset(mentions: DataFrame) -> DataFrame:
    """The most frequent asset type of a day and symbol; the alphabetically first of equally frequent ones."""
    return mentions.where("asset_type IS NOT NULL").groupBy(*KEY).agg(F.mode("asset_type", True).alias("asset_type"))


def subreddit_entropy(mentions: DataFrame) -> DataFrame:
    """Shannon entropy in bits of the subreddits of a day and symbol, from counts by two levels of aggregation."""
    counts = mentions.where("subreddit IS NOT NULL").groupBy(*KEY, "subreddit").count()
    n = F.sum("count")
    # H = log2(N) - sum(c log2 c) / N needs no total beside each row
    return counts.groupBy(*KEY).agg((F.log2(n) - F.sum(F.col("count") * F.log2("count")) / n + F.lit(0.0)).alias("subreddit_entropy"))


def daily_features(mentions: DataFrame) -> DataFrame:
    """The 22 features of each day and symbol of usable mentions.

    Rows without confidence count in counts and means but not in the weighted sentiment; all-null sums are 0;
    shares without a denominator are null. The entropy needs counts of its own; it is joined by the key that both share.
    """
    weights = F.sum("conf")
    base = mentions.groupBy(*KEY).agg(
        F.count("id").alias("chatter_count"),
        F.avg("sentiment_score").alias("sent_mean"),
        F.avg("conf").alias("avg_conf"),
        F.median("conf").alias("median_conf"),
        F.sum("score").alias("score_sum"),
        F.avg("score").alias("score_mean"),
        F.sum("num_comments").alias("comments_sum"),
        F.avg("num_comments").alias("comments_mean"),
        F.countDistinct("author").alias("unique_authors"),
        F.count_if("is_forward").cast("double").alias("forward_true_count"),
        F.count("is_forward").cast("double").alias("forward_total"),
        F.avg("value_score").alias("value_mean"),
        F.median("value_score").alias("value_median"),
        F.mode("asset_type", True).alias("asset_type"),  # of equally frequent ones the alphabetically first
        F.when(weights > 0, F.sum(F.col("sentiment_score") * F.col("conf")) / weights).alias("sent_weighted"),
    )
    base = (
        base.withColumn("forward_share", F.try_divide("forward_true_count", "forward_total"))
        .withColumn("engagement_sum", F.col("score_sum") + F.col("comments_sum"))
        .withColumn("engagement_mean", F.col("score_mean") + F.col("comments_mean"))
        .withColumn("user_concentration", F.try_divide("unique_authors", "chatter_count"))
    )
    return base.join(subreddit_entropy(mentions), KEY, "left")


#: The columns of the first version of the table.
FIRST_VERSION = [
    "day", "symbol", "chatter_count", "sent_mean", "avg_conf", "median_conf", "score_sum", "score_mean", "comments_sum", "comments_mean",
    "unique_authors", "sent_weighted", "engagement_sum", "engagement_mean", "user_concentration", "subreddit_entropy",
]
