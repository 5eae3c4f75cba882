"""Mapping freely typed values to the entries of a reference list: a set-similarity join with prefix filters.

Typed values and reference entries become strings of letters and digits, strings become sets of letter pairs. Pairs are
ordered by their rarity in the reference list; two sets can only reach the threshold if their prefixes (the rarest
pairs) share one, which is an equi-join. The threshold follows from the length: it admits one wrong letter. Length and position bounds discard most of what meets, the Jaccard coefficient
is verified exactly, and the best entry of each value is kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import strip
from tidemark.session import Workspace, ship

#: One wrong, missing or extra letter takes at most two pairs from the larger of two sets of m pairs, which leaves a
#: Jaccard coefficient of at least (m - 2) / (m + 2): the threshold is a matter of length.
LOST_PAIRS = 2
#: A misspelt symbol must stand for one of at least this many characters; first words of any length may be misspelt.
LEAST_FUZZY = 5
#: Candidates are handed on in frames of so many rows, however many a value has.
FRAME_ROWS = 4096
#: Reference lists up to this many strings are broadcast; longer ones are joined by shuffles.
BROADCAST_STRINGS = 100_000
#: Letter pairs whose frequency is known; all others count as the rarest.
RANKED = 50_000
LEGAL_FORMS = frozenset("corp corporation holdings holding group co company ltd limited se plc inc incorporated ag sa nv llc lp gmbh".split())
#: Words that stand around names; among others they name nothing, unless an entry is listed under one.
CONTEXT = LEGAL_FORMS | frozenset("the a an of and or in on at to my all share shares stock stocks common equity ordinary us usd eu uk".split())
WORD = re.compile(r"[^\W_]+")


def words_of(value: str) -> list[str]:
    """Runs of letters and digits, compatibility forms and case folded."""
    return WORD.findall(unicodedata.normalize("NFKC", value).casefold())


def candidates(words: list[str], lengths: frozenset[int], context: frozenset[str]) -> list[str]:
    """The strings of a value that may name an entry: its words and consecutive ones in one, of the given lengths."""
    longest = max(lengths, default=0)
    found = set()
    for i in range(len(words)):
        s = ""
        for j in range(i, len(words)):
            s += words[j]
            if len(s) > longest:
                break
            if len(s) in lengths:
                found.add(s)
    if len(words) > 1:
        found -= context
    return sorted(found)


def pairs_of(s: str) -> list[str]:
    """The letter pairs of a string with its ends; the second of two equal ones is marked, so that sets suffice."""
    seen: Counter = Counter()
    out = []
    for a, b in zip("^" + s, s + "$"):
        seen[a + b] += 1
        out.append(a + b if seen[a + b] == 1 else f"{a}{b}{seen[a + b]}")
    return out


def entry_strings(symbol: str, name: str | None) -> list[tuple[str, str]]:
    """(kind, string) under which an entry is known: symbol, full name, name without the legal form, first word."""
    out = [("symbol", "".join(words_of(symbol)))]
    words = words_of(name or "")
    if words:
        core = words[:-1] if len(words) > 1 and words[-1] in LEGAL_FORMS else words
        out += [("name", "".join(words)), ("core", "".join(core)), ("first", words[0])]
    return [(k, s) for k, s in out if s]


def prefix_rows(s: str, rarity: dict[str, int], lost: int = LOST_PAIRS) -> list[tuple[str, int]]:
    """(pair, position) of the prefix of a string, rarest pairs first: one more than may be lost.

    Pairs that no entry has match nothing; they keep their positions and are left out. Two single letters share no pair
    though one may stand for the other: they meet by the pair of ends.
    """
    ordered = sorted(pairs_of(s), key=lambda p: (rarity.get(p, 0), p))
    cut = len(rarity) >= RANKED  # pairs that are not ranked may then be among the entries all the same
    rows = [(p, i) for i, p in enumerate(ordered[: lost + 1]) if cut or p in rarity]
    return [*rows, ("^$", 0)] if lost and len(s) == 1 else rows


ENTRY = "symbol_ref string, kind string, rs string, inexact boolean, core string, rsize int, rpairs array<string>"


def listed_entries(reference: DataFrame, symbol: str, name: str) -> DataFrame:
    """The strings under which the entries are known, with their letter pairs."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sym, full in zip(batch["s"], batch["n"]):
                strings = entry_strings(sym, full)
                core = next((s for kind, s in strings if kind == "core"), "")
                rows += [(sym, kind, s, may_be_misspelt(kind, s), core, len(pairs_of(s)), pairs_of(s)) for kind, s in strings]
            yield pd.DataFrame(rows, columns=["symbol_ref", "kind", "rs", "inexact", "core", "rsize", "rpairs"])

    return reference.select(F.col(symbol).alias("s"), F.col(name).alias("n")).where("s IS NOT NULL").distinct().mapInPandas(spell, ENTRY)


def may_be_misspelt(kind: str, s: str) -> bool:
    return kind == "first" or (kind == "symbol" and len(s) >= LEAST_FUZZY)


SIDE = "s string, size int, pairs array<string>, pair string, pos int"


def match_values(values: DataFrame, reference: DataFrame, symbol: str, name: str) -> DataFrame:
    """(value, symbol_ref, kind, similarity) of the distinct non-blank values that stand for an entry.

    An exact string goes before a misspelt one, a longer one before a shorter; among equals the entry whose name is
    closest to the whole value wins, then the smallest symbol. An entry listed under a context word is named by it among
    other words if these name none. The reference list stays distributed; of it only the RANKED
    most frequent letter pairs, the lengths and the context words it lists come to the driver.
    """
    spark = values.sparkSession
    ship(spark)
    entries, n_entries = Workspace(spark, "p5").save(listed_entries(reference, symbol, name), "entries")
    seen = entries.agg(F.collect_set(F.struct(F.length("rs").alias("n"), "inexact")).alias("lengths"), F.collect_set(F.when(F.col("rs").isin(*sorted(CONTEXT)), F.col("rs"))).alias("context")).collect()[0]
    lengths = frozenset(r["n"] + d for r in seen["lengths"] for d in ((-1, 0, 1) if r["inexact"] else (0,)))
    named = sorted(seen["context"])
    context = CONTEXT - set(named)
    rarity = {r["p"]: r["count"] for r in entries.select("rs", "rpairs").distinct().select(F.explode("rpairs").alias("p")).groupBy("p").count().orderBy(F.desc("count"), "p").limit(RANKED).collect()}
    shared = spark.sparkContext.broadcast(rarity)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*r, p, i) for r in batch.itertuples(index=False) for p, i in prefix_rows(r.rs, shared.value, LOST_PAIRS if r.inexact else 0)]
            yield pd.DataFrame(rows, columns=[*batch.columns, "pair", "rpos"])

    index = entries.mapInPandas(place, ENTRY + ", pair string, rpos int")
    if n_entries <= BROADCAST_STRINGS:
        index = F.broadcast(index)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = ((v, words_of(v)) for batch in batches for v in batch["value"])
        found = ((v, "".join(w), c, pairs_of(c)) for v, w in split for c in candidates(w, lengths, context))
        rows = ((v, whole, c, len(c) + 1, pairs, p, i) for v, whole, c, pairs in found for p, i in prefix_rows(c, shared.value))
        for part in batched(rows, FRAME_ROWS):
            yield pd.DataFrame(list(part), columns=["value", "whole", "s", "size", "pairs", "pair", "pos"])

    # cheap to send, dear to take apart: spread over all cores, however few bytes the values are
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    probes = values.select("value").repartition(parts).mapInPandas(spread, "value string, whole string, " + SIDE)
    need = F.greatest("size", "rsize") - LOST_PAIRS
    met = (
        probes.join(index, "pair")
        .where(F.abs(F.col("size") - F.col("rsize")) <= 1)
        .where(1 + F.least(F.col("size") - F.col("pos") - 1, F.col("rsize") - F.col("rpos") - 1) >= need)
    )
    verified = met.withColumn("common", F.size(F.array_intersect("pairs", "rpairs"))).where(F.col("common") >= need)
    verified = verified.withColumn("similarity", F.col("common") / (F.col("size") + F.col("rsize") - F.col("common")))
    exact = F.col("s") == F.col("rs")
    fuzzy = F.col("inexact") & (F.levenshtein("s", "rs", 1) == 1)
    kept = verified.where(exact | fuzzy).withColumn("exact", exact).withColumn("apart", F.levenshtein("whole", "core"))
    # the best entry is a minimum: combined before the shuffle, no sort of a value's candidates
    weak = F.col("s").isin(*named) & (F.col("s") != F.col("whole"))
    order = F.struct(
        weak.alias("weak"), (~exact).alias("misspelt"), F.when(exact, -F.length("s")).otherwise(0).alias("shorter"), F.levenshtein("whole", "core").alias("apart"), (-F.col("similarity")).alias("unlike"), "symbol_ref", "kind", "similarity"
    )
    return kept.groupBy("value").agg(F.min(order).alias("m")).select("value", "m.symbol_ref", "m.kind", "m.similarity")


def map_column(df: DataFrame, column: str, reference: DataFrame, symbol: str, name: str) -> DataFrame:
    """``df`` with symbol_ref: the entry that ``column`` stands for, '' if none; null for null and blank values.

    Literal entries stand for themselves; a column of the name ``symbol_ref`` is replaced. The distinct other values are matched, each once, and joined back.
    """
    literal = reference.select(F.col(symbol).alias("__v"), F.col(symbol).alias("__literal")).where("__v IS NOT NULL").distinct()
    present = F.length(strip(column)) > 0
    values = df.select(F.col(column).alias("value")).where(F.length(strip("value")) > 0).groupBy("value").count()
    values = values.join(literal, F.col("value") == F.col("__v"), "left_anti").select("value")
    found = match_values(values, reference, symbol, name).select(F.col("value").alias("__value"), F.col("symbol_ref").alias("__ref"))
    joined = df.join(literal, F.col(column) == F.col("__v"), "left").join(found, F.col(column) == F.col("__value"), "left")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns if c != "symbol_ref"), F.when(present, F.coalesce("__literal", "__ref", F.lit(""))).alias("symbol_ref"))
