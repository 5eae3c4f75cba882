"""Bounded samples for fitting, drawn by ranges of hashes without moving the corpus."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: The first range of hashes holds about so many times the rows that are wanted; each further one is so much wider.
SPARE, WIDER = 4, 16


def shares(rows: int, wanted: int, spare: float = SPARE) -> Iterator[float]:
    """Growing shares of all hashes, the last one whole: for ``wanted`` of ``rows`` if they are distinct, then wider."""
    share = spare * wanted / max(1, rows)
    while share < 1:
        yield share
        share *= WIDER
    yield 1.0


def within(column: str, share: float) -> Column:
    """Whether the hash of the column lies in the lowest ``share`` of all hashes."""
    return F.lit(True) if share >= 1 else F.xxhash64(column) < F.lit(-(1 << 63) + int(share * (1 << 64)))


def smallest_hashes(df: DataFrame, column: str, most: int) -> list[Row]:
    """Those ``most`` distinct values of ``column`` (all, if there are fewer) whose hashes are smallest.

    A range of hashes narrows the rows before anything is shuffled. Where rows repeat each other so much that the range
    holds too few values, it is widened until it is filled or covers all rows; the values are the same in either case.
    """
    rest = [c for c in df.columns if c != column]
    for share in shares(df.count(), most):
        part = df.where(within(column, share))
        once = part.groupBy(column).agg(*(F.min(c).alias(c) for c in rest)) if rest else part.distinct()
        found = once.orderBy(F.xxhash64(column), column).limit(most).collect()
        if len(found) == most or share == 1:
            return found
    return []
