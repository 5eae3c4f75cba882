"""References to records that do not exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_references(df: DataFrame, key: Column, period: Column, since: Column | None = None) -> DataFrame:
    """(key, period, since, refs) of the non-null keys; ``since`` is the earliest delivery that uses the key.

    The distinct keys are formed before anything is joined, so a key with a third of all rows is one row per
    period by then (the partial aggregation runs before the shuffle).
    """
    picked = df.select(key.alias("key"), period.alias("period"), (F.lit(None).cast("long") if since is None else since.cast("long")).alias("since"))
    return picked.where("key IS NOT NULL").groupBy("key", "period", "since").agg(F.count(F.lit(1)).alias("refs"))


def orphans(references: DataFrame, parents: DataFrame, condition: Column | None = None) -> DataFrame:
    """The references r without a parent p of the same key (and with ``condition`` over r and p): a left anti-join."""
    r, p = references.alias("r"), parents.alias("p")
    on = F.col("r.key") == F.col("p.key")
    return r.join(p, on if condition is None else on & condition, "left_anti")


def orphan_report(references: DataFrame, missing: DataFrame, source: str) -> DataFrame:
    """(source_table, period, refs, keys, orphan_refs, orphan_keys): the orphans joined back to all references."""
    all_ = references.groupBy("period").agg(F.sum("refs").alias("refs"), F.countDistinct("key").alias("keys"))
    lost = missing.groupBy(F.col("period").alias("lost_period")).agg(F.sum("refs").alias("orphan_refs"), F.countDistinct("key").alias("orphan_keys"))
    joined = all_.join(lost, F.col("period").eqNullSafe(F.col("lost_period")), "left")
    return joined.select(F.lit(source).alias("source_table"), "period", "refs", "keys", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("orphan_refs", "orphan_keys")))
