"""Tolerant coercions: values that do not fit become a default or null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def whole_number(c: Column | str, kind: str = "bigint") -> Column:
    """A JSON scalar rendered as text: whole numbers in text count, ``3.7`` in text does not (0); nulls are 0."""
    return F.coalesce(_col(c).cast("string").try_cast(kind), F.lit(0).cast(kind))


def number(c: Column | str) -> Column:
    """A double, or null; NaN counts as missing."""
    x = _col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(x), x)


def flag(c: Column | str) -> Column:
    """True for true (as a boolean or text in any case), else false."""
    return F.coalesce(F.lower(_col(c).cast("string")) == "true", F.lit(False))


def tri_state(c: Column | str) -> Column:
    """true/1/yes/y, false/0/no/n in any case and with outer blanks; everything else is null."""
    x = F.lower(F.trim(_col(c).cast("string")))
    return F.when(x.isin("true", "1", "yes", "y"), True).when(x.isin("false", "0", "no", "n"), False)


def unit_interval(c: Column | str) -> Column:
    """Clipped to [0, 1]; null stays null."""
    x = _col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def epoch_day(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c)).cast("date")


#: Values of the annotation contract (fixed values).
ASSET_TYPES = ("equity", "etf", "reit", "index", "commodity", "fx", "crypto", "bond", "other")


def sentiment_label(c: Column | str) -> Column:
    x = F.lower(F.trim(_col(c)))
    return F.when(x.isin("positive", "negative", "neutral"), x).when(x == "bullish", "positive").when(x == "bearish", "negative").when(x.isNotNull(), "neutral")


def asset_type(c: Column | str) -> Column:
    x = F.lower(F.trim(_col(c)))
    return F.when(x.isin(*ASSET_TYPES), x).when(x.isNotNull(), "other")
