"""Pairing records with the nearest record in time of the same entity, within a tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def nearest_intervals(right: DataFrame, tolerance: int) -> DataFrame:
    """Of distinct (entity, t): (entity, t, lo, hi), the times whose nearest is t, bounded by midpoints and tolerance.

    A time just between two neighbours belongs to the earlier. Neighbours further off than twice the tolerance do
    not bound anything, so they are looked up inside blocks of time whose edges hold copies of the nearby rows of the
    next block: an entity with a third of all rows is spread over as many tasks as it has blocks.
    """
    reach = 2 * tolerance + 1
    width = 8 * reach
    block = F.floor(F.col("t") / F.lit(width)).cast("long")
    copied = right.withColumn("home", block).withColumn(
        "blk", F.explode(F.array_distinct(F.array("home", F.floor((F.col("t") - reach) / width).cast("long"), F.floor((F.col("t") + reach) / width).cast("long"))))
    )
    w = W.partitionBy("entity", "blk").orderBy("t")
    near = copied.select("entity", "t", "blk", "home", F.lag("t").over(w).alias("before"), F.lead("t").over(w).alias("after")).where("blk = home")
    lo = F.greatest(F.col("t") - tolerance, F.expr("before + (t - before) div 2 + 1"))
    hi = F.least(F.col("t") + tolerance, F.expr("t + (after - t) div 2"))
    return near.select("entity", "t", lo.alias("lo"), hi.alias("hi"))


def nearest(left: DataFrame, right: DataFrame, entity: str, left_time: Column, right_entity: Column, right_time: Column, tolerance: int) -> DataFrame:
    """``left`` with ``nearest``: the time of the nearest right row of the entity within ``tolerance``, null if none.

    Times are whole numbers (days, seconds). Nulls in an entity or time match nothing; repeated right rows count
    once; repeated left rows stay; a left column of the name ``nearest`` is replaced. Both sides meet in an equi-join on (entity, bin), with bins as wide as the
    longest interval, so that an interval lies in at most two bins and no range of times is compared across them.
    """
    t = right.select(right_entity.alias("entity"), right_time.cast("long").alias("t")).where("entity IS NOT NULL AND t IS NOT NULL").distinct()
    width = 2 * tolerance + 1
    spans = nearest_intervals(t, tolerance).select(
        F.col("entity").alias("__entity"), F.col("t").alias("__nearest"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.explode(F.expr(f"sequence(floor(lo / {width}), floor(hi / {width}))")).alias("__rbin")
    )
    kept = [c for c in left.columns if c != "nearest"]
    l = left.withColumn("__t", left_time.cast("long")).withColumn("__bin", F.floor(F.col("__t") / width))
    joined = l.join(spans, (F.col(f"`{entity}`") == F.col("__entity")) & (F.col("__bin") == F.col("__rbin")) & F.col("__t").between(F.col("__lo"), F.col("__hi")), "left")
    return joined.select(*(F.col(f"`{c}`") for c in kept), F.col("__nearest").alias("nearest"))
