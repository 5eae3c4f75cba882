"""Comparable forms of keys that people and feeds write in different ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OUTER_BLANKS = r"(?U)^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$"


def strip(c: Column | str) -> Column:
    """Without outer blanks of any kind (``trim`` knows only the space)."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, OUTER_BLANKS, "")


def thread_key(c: Column | str) -> Column:
    """A post or comment key without its ``t1_``/``t3_`` prefix, case and outer blanks; blank keys become null."""
    return F.nullif(F.regexp_replace(F.lower(strip(c)), "^t[13]_", ""), F.lit(""))


def symbol_key(c: Column | str) -> Column:
    """A symbol in upper case without outer blanks; blank ones become null."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def month_of_epoch(c: Column | str) -> Column:
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM")
