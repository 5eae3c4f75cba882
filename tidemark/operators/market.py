"""Prices, returns, the merge with daily features, and lagged, rolling and forward features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from tidemark.functions.keys import symbol_key

def by_day() -> WindowSpec:
    """The one window that all features share: a symbol's rows in the order of days."""
    return W.partitionBy("symbol").orderBy("day")


def last_rows(n: int) -> WindowSpec:
    return by_day().rowsBetween(1 - n, 0)


def bars_from_ticks(ticks: DataFrame, symbol: str, time: str, price: str, tie: str) -> DataFrame:
    """(symbol, day, Open, High, Low, Close, Volume) from ticks; ties in time are ordered by ``tie``, Volume counts ticks."""
    first, last = F.struct(F.col(time), F.col(tie)), F.struct(F.col(time), F.col(tie))
    return ticks.where(F.col(price).isNotNull()).groupBy(F.col(symbol).alias("symbol"), F.to_date(time).alias("day")).agg(
        F.min_by(price, first).alias("Open"), F.max(price).alias("High"), F.min(price).alias("Low"), F.max_by(price, last).alias("Close"), F.count(price).alias("Volume")
    )


def wide_to_long(wide: DataFrame, day: str, symbols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Columns ``SYMBOL|FIELD`` as rows (day, symbol, fields); rows in which every field is null are dropped."""
    entries = F.array(*(F.struct(F.lit(s).alias("symbol"), *(F.col(f"`{s}|{f}`").cast("double").alias(f) for f in fields)) for s in symbols))
    return wide.select(F.col(day).alias("day"), F.explode(entries).alias("e")).select("day", "e.*").where(F.coalesce(*fields).isNotNull())


def unique_bars(prices: DataFrame) -> DataFrame:
    """One bar per normalised symbol and day: of repeated rows the one with the greatest close, then volume and so on."""
    order = ["Close", "Volume", "Open", "High", "Low", "Adj Close"]
    named = prices.withColumn("symbol", symbol_key("symbol")).where("symbol IS NOT NULL AND day IS NOT NULL").select("symbol", "day", *(F.col(f"`{c}`") for c in order))
    best = named.groupBy("symbol", "day").agg(F.max(F.struct(*(F.col(f"`{c}`") for c in order))).alias("b"))
    return best.select("symbol", "day", *(F.col(f"b.`{c}`").alias(c) for c in order))


def gated(f, c: Column | str, n: int, least: int = 3) -> Column:
    """A rolling statistic over n rows, null where fewer than ``least`` values are present."""
    w = last_rows(n)
    return F.when(F.count(c).over(w) >= least, f(c).over(w))


def pct_change(c: Column, steps: int) -> Column:
    """The change against ``steps`` rows before (after, if negative); null where the divisor is missing or 0."""
    other = F.lag(c, steps).over(by_day()) if steps > 0 else F.lead(c, -steps).over(by_day())
    return F.try_divide(c, other) - 1


def with_returns(bars: DataFrame, fill: bool = True) -> DataFrame:
    """Returns over 1 and 5 rows of the adjusted close (the close where there is no such column), their rolling
    deviation and the rolling volume. ``fill`` carries the last price over gaps, as percent changes by default did."""
    price = "Adj Close" if "Adj Close" in bars.columns else "Close"
    padded = F.last(F.col(f"`{price}`"), ignorenulls=True).over(by_day().rowsBetween(W.unboundedPreceding, 0)) if fill else F.col(f"`{price}`")
    return (
        bars.withColumn("__p", padded)
        .withColumn("ret1", pct_change(F.col("__p"), 1))
        .withColumn("ret5", pct_change(F.col("__p"), 5))
        .withColumn("ret1_roll_std", gated(F.stddev_samp, "ret1", 5))
        .withColumn("vol_roll_mean", gated(F.avg, "Volume", 5))
        .drop("__p")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; reading it fails if a key occurs twice (the many-to-one check of a merge, without a second pass)."""
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    checked = df.withColumn("__n", F.when(n == 1, n).otherwise(F.raise_error(F.concat(F.lit("merge keys are not unique: "), F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))))))
    return checked.where("__n IS NOT NULL").drop("__n")


def merge_features(daily: DataFrame, bars: DataFrame, validate: bool = True) -> DataFrame:
    """Daily features with the bar of the same symbol (apart from case and outer blanks) and day; days without a bar fall out."""
    d, b = (x.withColumn("symbol", symbol_key("symbol")) for x in (daily, bars))
    return d.join(require_unique(b, ["symbol", "day"]) if validate else b, ["symbol", "day"])


#: Columns of the modelling table (fixed values).
LAGGED = (
    "chatter_count", "unique_authors", "user_concentration", "sent_mean", "sent_weighted", "avg_conf", "median_conf", "engagement_sum",
    "comments_sum", "score_sum", "subreddit_entropy", "forward_true_count", "forward_share", "value_mean", "value_median",
)
#: The narrower families of the first version of the table.
FIRST_LAGGED, FIRST_SUMMED, FIRST_AVERAGED = LAGGED[:11], ("chatter_count", "engagement_sum"), ("sent_mean", "sent_weighted")
SUMMED = ("chatter_count", "engagement_sum", "forward_true_count")
AVERAGED = ("sent_mean", "sent_weighted", "avg_conf", "median_conf", "forward_share", "value_mean")
DELTAS = {"delta_chatter": "chatter_count", "delta_sent_mean": "sent_mean", "delta_engagement_sum": "engagement_sum"}


def lags(columns: Sequence[str] = LAGGED, steps: Sequence[int] = (1, 2, 3)) -> dict[str, Column]:
    return {f"{c}_lag{s}": F.lag(c, s).over(by_day()) for s in steps for c in columns}


def rolls(sums: Sequence[str] = SUMMED, means: Sequence[str] = AVERAGED, windows: Sequence[int] = (3, 7, 14, 30)) -> dict[str, Column]:
    return {f"{c}_roll{n}_{label}": f(c).over(last_rows(n)) for n in windows for cols, f, label in ((sums, F.sum, "sum"), (means, F.avg, "mean")) for c in cols}


def market_rolls() -> dict[str, Column]:
    out = {f"ret1_roll{n}_std": gated(F.stddev_samp, "ret1", n) for n in (5, 14, 30)}
    for n in (5, 20):
        mean = gated(F.avg, "Volume", n)
        out |= {f"vol_roll{n}_mean": mean, f"rel_volume_{n}": F.try_divide(F.col("Volume"), mean)}
    return out


def deltas() -> dict[str, Column]:
    return {name: F.col(c) - F.lag(c, 1).over(by_day()) for name, c in DELTAS.items()}


def momentum() -> dict[str, Column]:
    before = F.lag("Close", 5).over(by_day())
    return {"intraday_range": F.try_divide(F.col("High") - F.col("Low"), F.col("Close")), "Close_lag5": before, "momentum_5": F.try_divide(F.col("Close"), before) - 1}


def targets(price: str = "Adj Close") -> dict[str, Column]:
    """``ret1_lead{H}`` is today's price over the one H rows on, less 1 (as the feature table has always had it);
    ``fwd_ret{H}`` is the forward return proper."""
    p = F.col(f"`{price}`")
    out = {f"ret1_lead{h}": pct_change(p, -h) for h in (1, 2, 5)}
    return out | {f"fwd_ret{h}": F.try_divide(F.lead(p, h).over(by_day()), p) - 1 for h in (1, 2, 5)}


def enrich(merged: DataFrame, steps: Sequence[int] = (1, 2, 3), windows: Sequence[int] = (3, 7, 14, 30), with_targets: bool = True, scope: str = "history", first_version: bool = False) -> DataFrame:
    """All lagged, rolling, market and forward features; frames are rows of one symbol in the order of days.

    Every window shares one partitioning and order, so there is one exchange and one sort. ``scope='partition'`` keeps
    each day by itself (all lags null), as a run over single-day partitions would. ``first_version`` has fewer families.
    """
    lagged, summed, averaged = (FIRST_LAGGED, FIRST_SUMMED, FIRST_AVERAGED) if first_version else (LAGGED, SUMMED, AVERAGED)
    extra = lags(lagged, steps) | rolls(summed, averaged, windows) | market_rolls() | deltas() | momentum() | (targets() if with_targets else {})
    if scope == "partition":
        null_ = [n for n in extra if "_lag" in n or n.startswith(("delta_", "ret1_lead", "fwd_ret", "ret1_roll", "vol_roll", "rel_volume")) or n == "momentum_5"]
        alone = {f"{c}_roll{n}_{label}": F.col(c) for n in windows for cols, label in ((summed, "sum"), (averaged, "mean")) for c in cols}
        extra = extra | alone | {n: F.lit(None).cast("double") for n in null_}
    return merged.withColumns(extra)
