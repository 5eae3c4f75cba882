"""Text expressions: normalisation, character shares and spam flags, all of them built-in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"(?U)[\s\x1c-\x1f]+"
URL, WORD = r"(https?://\S+)", r"([A-Za-z0-9]+)"
GONE = ("", "[deleted]", "[removed]")


def squash(c: Column) -> Column:
    """Runs of white space as one space, none at the ends; null as ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BLANKS, " "))


def outer_strip(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clipped(c: Column, most: int) -> Column:
    """The first ``most`` characters, without outer white space."""
    return outer_strip(F.substring(F.coalesce(c, F.lit("")), 1, most))


def joined_text(title: Column, body: Column) -> Column:
    return outer_strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))))


def matched_length(c: Column, pattern: str) -> Column:
    """Characters inside all matches of a pattern with one group."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def is_gone(c: Column) -> Column:
    """Deleted, removed, blank or null."""
    return F.lower(outer_strip(c)).isin(*GONE)


def spam_flags(title: Column, body: Column) -> dict[str, Column]:
    """The five flags of a text; ``title`` may be a null literal where there is none."""
    t, b = squash(title), squash(body)
    both = F.trim(F.concat(t, F.lit(" "), b))
    n = F.length(both)
    return {
        "is_empty_text": (F.length(t) == 0) & (F.length(b) == 0),
        "has_repeat": both.rlike(r"(.)\1{4,}"),
        "too_many_symbols": (n >= 40) & (F.lit(1.0) - matched_length(both, WORD) / F.greatest(n, F.lit(1)) > 0.55),
        "title_all_caps": (F.length(t) >= 8) & (F.upper(t) == t) & t.rlike(r"\p{L}"),
        "body_mostly_urls": (F.length(b) >= 8) & (matched_length(b, URL) / F.greatest(F.length(b), F.lit(1)) > 0.7),
    }
