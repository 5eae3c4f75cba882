"""Evaluation passages in a corpus: Wu-Manber search for many strings at once.

Texts and passages are compared as strings of letters and digits (compatibility forms folded, case folded, everything
else dropped), so punctuation, spacing and markup make no difference. The test strings are all runs of ``words``
consecutive words of each passage. A table of character blocks tells how far the search may shift; where the shift is
zero, the bucket of the block holds the strings that may end there, and direct comparison confirms them. A confirmed
string must begin and end at word ends of the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

SEPARATORS = re.compile(r"[\W_]+")
BLOCK = 10
#: Words of passages whose tables are held at once; further passages are searched in further passes.
WORDS_PER_PASS = 100_000
#: So many sets of them are searched in one pass over the corpus.
AT_ONCE = 4


def fold(text: str) -> str:
    return unicodedata.normalize("NFKC", text).casefold()


def squeeze(folded: str) -> str:
    return SEPARATORS.sub("", folded)


def test_strings(passage: str | None, words: int) -> list[str]:
    """Each run of ``words`` words of a passage as letters and digits; a word is what blanks separate."""
    tokens = [w for w in map(squeeze, fold(passage or "").split()) if w]
    return ["".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)]


class Searcher:
    """Shift table and buckets of a set of (string, item)."""

    def __init__(self, strings: Iterable[tuple[str, int]]):
        owners: dict[str, set[int]] = {}
        for s, item in strings:
            owners.setdefault(s, set()).add(item)
        self.owners = owners
        self.length = min(map(len, owners), default=0)
        self.block = min(BLOCK, self.length)
        self.furthest = self.length - self.block + 1
        self.shift: dict[str, int] = {}
        self.buckets: dict[str, list[str]] = {}
        for s in owners:
            for at in range(self.furthest):
                b = s[at : at + self.block]
                left = self.length - at - self.block
                if left < self.shift.get(b, self.furthest):
                    self.shift[b] = left
            self.buckets.setdefault(s[self.length - self.block : self.length], []).append(s)

    def occurrences(self, text: str) -> Iterator[tuple[int, str]]:
        """(position, string) of each test string in a squeezed text."""
        end, size, n = self.length, self.block, len(text)
        shift, furthest = self.shift.get, self.furthest
        while end <= n:
            step = shift(text[end - size : end], furthest)
            if step:
                end += step
                continue
            for s in self.buckets.get(text[end - size : end], ()):
                if text.startswith(s, end - self.length):
                    yield end - self.length, s
            end += 1

    def items(self, text: str | None) -> set[int]:
        found: set[int] = set()
        if not text or not self.length:
            return found
        folded = fold(text)
        squeezed, ends = squeeze(folded), None
        for at, s in self.occurrences(squeezed):
            if self.owners[s] <= found:
                continue
            if ends is None:
                ends = word_ends(folded)
            if at in ends and at + len(s) in ends:
                found |= self.owners[s]
        return found


def word_ends(folded: str) -> set[int]:
    """Positions of the squeezed text at which a word begins or ends."""
    ends, at = {0}, 0
    for w in SEPARATORS.split(folded):
        at += len(w)
        ends.add(at)
    return ends


def passes(items: DataFrame, item_id: str, passage: str, words: int) -> Iterator[Searcher]:
    """Searchers over all items, each of at most WORDS_PER_PASS words (or of one passage)."""
    held: list[tuple[str, int]] = []
    for row in items.select(item_id, passage).where(F.col(passage).isNotNull()).toLocalIterator():
        held += [(s, row[0]) for s in test_strings(row[1], words)]
        if len(held) >= WORDS_PER_PASS:
            yield Searcher(held)
            held = []
    if held:
        yield Searcher(held)


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, words: int = 15) -> DataFrame:
    """(doc_id, item_id) of each document that holds at least ``words`` consecutive words of an item's passage.

    Null and empty texts and passages, and passages of fewer words, give no rows; repeated documents give one.
    """
    schema = docs.select(doc_id).schema.add("item_id", items.schema[item_id].dataType)
    ship(docs.sparkSession)
    found = docs.sparkSession.createDataFrame([], schema)
    for some in batched(passes(items, item_id, passage, words), AT_ONCE):
        tables = [docs.sparkSession.sparkContext.broadcast(searcher) for searcher in some]

        def search(batches: Iterator[pd.DataFrame], tables=tables) -> Iterator[pd.DataFrame]:
            looks = [t.value.items for t in tables]
            for batch in batches:
                pairs = [(d, i) for d, t in zip(batch.iloc[:, 0], batch.iloc[:, 1]) for look in looks for i in look(t)]
                yield pd.DataFrame(pairs, columns=[doc_id, "item_id"])

        found = found.unionByName(docs.select(doc_id, text).where(F.length(text) > 0).mapInPandas(search, schema))
    return found.distinct()
