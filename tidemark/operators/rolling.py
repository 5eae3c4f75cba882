"""Rolling totals over trailing calendar periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def daily_totals(df: DataFrame, entity: str, day: str, values: Sequence[str]) -> DataFrame:
    """One row per entity and day; rows that are identical in all columns count once. Null values add nothing.

    Rows without an entity or day are left out. ``active`` says that the day has at least one row.
    """
    present = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    # two hashes stand for the columns that are not summed; within one entity and day 96 bits do not meet by chance
    once = present.select(entity, day, *values, F.xxhash64(*df.columns).alias("__a"), F.hash(*df.columns).alias("__b")).distinct()
    return once.groupBy(F.col(entity).alias("entity"), F.col(day).alias("day")).agg(*(F.sum(v).alias(v) for v in values))


def densify(daily: DataFrame) -> DataFrame:
    """All days between an entity's first and last, each entity with its own stretch of the calendar."""
    span = daily.groupBy("entity").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.select("entity", F.explode(F.sequence("lo", "hi")).alias("day"))
    return calendar.join(daily.withColumn("active", F.lit(True)), ["entity", "day"], "left").withColumn("active", F.coalesce("active", F.lit(False)))


def trailing(df: DataFrame, entity: str, day: str, values: Sequence[str], periods: Sequence[int]) -> DataFrame:
    """(entity, day, active, V, V_sum_P, V_avg_P) for each day from an entity's first to its last.

    Sums treat days without activity and null values as zero; an average divides by the days of the period that
    lie on or after the entity's first day. After the daily aggregation an entity has at most one row per calendar
    day, so a hot entity is combined before the shuffle and its window stays as small as the calendar.
    """
    dense = densify(daily_totals(df, entity, day, values))
    zeroed = dense.select("entity", "day", "active", *(F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values))
    w = W.partitionBy("entity").orderBy("day")
    out = [f(v).over(w.rowsBetween(1 - p, 0)).alias(f"{v}_{label}_{p}") for v in values for p in periods for f, label in ((F.sum, "sum"), (F.avg, "avg"))]
    return zeroed.select(F.col("entity").alias(entity), F.col("day").alias(day), "active", *values, *out)
