"""Deduplicating new batches against all history with a persisted inverted file of vectors.

A text is a vector with one coordinate per word and occurrence (the second "the" is a coordinate of its own), so that
the distance of two vectors is the number of words that one has and the other lacks. If four fifths of the longer text
stand in the other, their distance is at most two fifths of its length.

Coordinates are ordered once by their frequency in a sample, rarest first. In a small history a cell belongs to one
coordinate: an accepted vector is filed in the cells of its leading coordinates, a new one probes the cells of its own, and
both may stop as soon as the coordinates already seen put every vector not yet met beyond the distance: after a fifth of
the length plus one. Where texts are many, a coordinate that is not rare would be met by a fixed share of them all, so a
cell belongs to several coordinates. These are dealt into PARTS; of ``(d - 1) * PARTS + 1`` common coordinates, ``d`` lie
in one part, so vectors within the distance share ``d`` coordinates of one part if both look so much further. Cells are
these combinations, cut where the coordinates taken are rare enough together (see ``cells_of``): nothing is lost, and what
a probe meets by chance shrinks with every coordinate. Bounds by length, by position and by a sketch of parities, which
never exceeds the distance, discard nearly all of what is met inside the join; what is left is compared word by word
(longest common subsequence).

``History`` is a folder that outlives the session: ``History.open`` finds the order, the cells and the accepted texts as
they were left. Everything lies in buckets by the hash of the cell, text or key; a batch reads the buckets it touches, and
the words of accepted texts only where the bounds left a candidate. Neither texts nor vectors of the history are computed
again. A batch is a generation, which counts once its marker is written: a session that dies leaves no half of one.

Texts that are equal word for word are one class with one vector; only their ids are kept apart.

``repeated_records`` answers for many batches that are there already: it meets all texts once, by the same cells and
bounds, and then accepts and rejects batch by batch along the pairs found.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.llm.sampling import smallest_hashes
from tidemark.session import Workspace, ship

SHARE = 0.8
LEAST_WORDS, LEAST_DIFFERENT = 60, 30
#: Coordinates whose frequency is known; all others count as the rarest and are ordered by their hash.
RANKED = 50_000
#: Texts that the frequencies are taken from, and those of them (with the most frequent coordinates) that show which coordinates go together.
SAMPLE_TEXTS, TOGETHER = 20_000, (3_000, 1_000)
#: Into so many parts coordinates are dealt; a cell belongs to DEEPEST of them at most, each counted as BITS_A_COORDINATE
#: when the depth is chosen, and to no more than leave CELL_TEXTS texts in it by their frequencies. Two texts within the
#: distance share 48 coordinates or more, so (DEEPEST - 1) * PARTS + 1 may not exceed 48.
PARTS, DEEPEST, BITS_A_COORDINATE, CELL_TEXTS = 8, 6, 3.5, 50
#: What one bucket of a new history should hold of the first batch, and how many there may be.
CELLS_A_BUCKET, BUCKETS = 200_000, (4, 4096)
FEW_BUCKETS = 16
#: Rows of a batch that are sent to all executors; more are shuffled.
BROADCAST_ROWS = 300_000
#: The same for rows that hold whole texts.
BROADCAST_TEXTS = 20_000
#: Cells that ``repeated_records`` joins at once: so many in all, or so many a text; more go in several rounds.
ROUND_CELLS, ROUND_CELLS_A_TEXT = 2_000_000, 6

#: Letters that look like Latin ones (fixed values).
LOOK_ALIKE = str.maketrans(
    "АВЕЅІЈКМНОРСТУХԛԜаеѕіјорсухѵһԁԝкмтвнг" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχ" + "ıɡ",
    "ABESIJKMHOPCTYXqWaesijopcyxvhdwkmtbhr" + "ABEZHIKMNOPTYXaikvoptux" + "ig",
)


def words_of(text: str) -> list[str]:
    """The words of a text apart from case, punctuation, spacing and look-alike characters."""
    plain = unicodedata.normalize("NFKC", text).translate(LOOK_ALIKE).casefold()
    return [w for w in ("".join(filter(str.isalnum, t)) for t in plain.split()) if w]


def coordinates(words: list[str]) -> list[str]:
    """Each word with the number of its occurrence."""
    seen: dict[str, int] = {}
    out = []
    for w in words:
        seen[w] = n = seen.get(w, 0) + 1
        out.append(w if n == 1 else f"{w}\t{n}")
    return out


def prefix_length(n: int) -> int:
    """So many leading coordinates of a vector of length ``n`` meet one of any vector within the distance."""
    return n - math.ceil(SHARE * n - 1e-9) + 1


def common_words(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, by bit-parallel steps."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for w in b:
        met = free & where.get(w, 0)
        free = ((free + met) | (free - met)) & full
    return len(a) - free.bit_count()


def repeats(a: list[str], b: list[str]) -> bool:
    most = max(len(a), len(b))
    return min(len(a), len(b)) >= SHARE * most - 1e-9 and common_words(a, b) >= SHARE * most - 1e-9


@dataclass
class Order:
    """The order of coordinates and the rule by which cells are made of them; the same for all vectors of a history."""

    #: Of each listed coordinate its place from rare to frequent, the bits that it tells (how rare it is) and its part.
    places: dict[str, tuple[int, float, int]]
    #: Coordinates of a cell at most, the bits at which fewer do, the bits of a coordinate that is not listed.
    depth: int = 1
    enough: float = 0.0
    rare: float = 0.0


def dealt(coordinate_lists: list[list[str]], frequent: list[str]) -> dict[str, int]:
    """The part of each of the frequent coordinates, the most frequent first, so that those that go together lie apart."""
    at = {c: k for k, c in enumerate(frequent)}
    has = np.zeros((len(coordinate_lists), len(frequent)), np.float32)
    for i, cs in enumerate(coordinate_lists):
        has[i, [at[c] for c in cs if c in at]] = 1
    together = has.T @ has
    load, parts = np.zeros((len(frequent), PARTS), np.float32), {}
    for k, c in enumerate(frequent):
        parts[c] = part = int(load[k].argmin())
        load[:, part] += together[:, k]
    return parts


def arranged(texts: DataFrame, n: int) -> Order:
    """The order of coordinates and the depth of cells for a history that begins with these ``n`` texts (class, words)."""
    lists = [coordinates(r["words"].split(" ")) for r in smallest_hashes(texts.select("class", "words"), "class", SAMPLE_TEXTS)]
    counts = sorted(Counter(c for cs in lists for c in cs).items(), key=lambda x: (-x[1], x[0]))
    listed, most = counts[:RANKED], max(1, len(lists))
    enough = math.log2(max(1.0, n / CELL_TEXTS))
    depth = min(DEEPEST, max(1, math.ceil(enough / BITS_A_COORDINATE)))
    parts = dealt(lists[: TOGETHER[0]], [c for c, _ in listed[: TOGETHER[1]]]) if depth > 1 else {}
    places = {c: (RANKED - i, math.log2(most / k), parts.get(c, -1)) for i, (c, k) in enumerate(listed)}
    return Order(places, depth, enough, math.log2(most / (listed[-1][1] if len(counts) > RANKED else 1)))


def cells_of(keyed: list[tuple[int, int, float, int]], depth: int, enough: float) -> tuple[list[int], list[int]]:
    """The cells of a vector, and for each the place by which its match with another vector is bounded.

    ``keyed`` has (place, hash, bits, part) of each coordinate, sorted. Vectors of n and m coordinates within the distance
    lack at most ``n - ceil(SHARE * n)`` of the one, so their first ``t = (depth - 1) * PARTS + 1`` common coordinates are
    among the first ``prefix_length(n) + t - 1`` of either, and ``depth`` of these lie in one part. Both vectors have that
    combination, and cut it at the same coordinate: where those taken tell ``enough`` bits. At most ``t - depth + d`` common
    coordinates come up to the ``d``-th of the first such combination; the place says so as if they were one.
    """
    t = (depth - 1) * PARTS + 1
    leading = keyed[: prefix_length(len(keyed)) + t - 1]
    if depth == 1:
        return [k[1] for k in leading], list(range(len(leading)))
    parts: list[list[tuple[int, int, float]]] = [[] for _ in range(PARTS)]
    for at, (_, h, bits, part) in enumerate(leading):
        parts[part].append((at, h, bits))
    cells: list[int] = []
    places: list[int] = []

    def walk(own: list[tuple[int, int, float]], start: int, d: int, told: float, cell: int) -> None:
        for k in range(start, len(own) - depth + d):
            at, h, bits = own[k]
            h ^= cell * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
            if d == depth or told + bits >= enough:
                cells.append(h)
                places.append(at - t + depth - d + 1)
            else:
                walk(own, k + 1, d + 1, told + bits, h)

    for own in parts:
        walk(own, 0, 1, 0.0, 0)
    return cells, places


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def parities(hashes: list[int]) -> list[int]:
    """A sketch of 256 bits: each coordinate flips one of them, so two sketches differ in at most as many bits as the vectors do in coordinates."""
    bits = [0, 0, 0, 0]
    for h in hashes:
        bits[h >> 6 & 3] ^= 1 << (h & 63)
    return [signed(b) for b in bits]


VECTOR = "vid bigint, leading array<bigint>, at array<int>, s0 bigint, s1 bigint, s2 bigint, s3 bigint, size int"
#: What the shelves of a history hold: delivered ids, cells, accepted texts, the ids of these.
SHELVES = {
    "ids": "bucket int, kind string, key string, id string",
    "cells": "bucket int, cell bigint, pos int, vid bigint, size int, s0 bigint, s1 bigint, s2 bigint, s3 bigint",
    "texts": "bucket int, vid bigint, class string, kind string, words string",
    "members": "bucket int, class string, id string",
}


#: How the order lies on disk: a row for each listed coordinate, and one without any for the rule.
ORDER = "c string, place int, bits double, part int, buckets int, depth int, enough double"


def prepared(df: DataFrame, *more: str) -> DataFrame:
    """(kind, id, class, words, more): the texts of (kind, id, text, more) that are long and varied enough to be compared.

    A class is a text apart from its form, within its kind; different kinds are never compared.
    """

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for kind, i, text, *rest in zip(*(batch[c] for c in ("kind", "id", "text", *more))):
                words = words_of(text)
                if len(words) >= LEAST_WORDS and len(set(words)) >= LEAST_DIFFERENT:
                    joined = " ".join(words)
                    rows.append((kind, i, hashlib.md5(f"{kind} {joined}".encode("utf-8", "replace")).hexdigest(), joined, *rest))
            yield pd.DataFrame(rows, columns=["kind", "id", "class", "words", *more])

    long_enough = df.where(F.length("text") >= 2 * LEAST_WORDS - 1)
    kept = "".join(f", {c} {kind}" for c, kind in df.select(*more).dtypes)
    return long_enough.select("kind", "id", "text", *more).mapInPandas(prepare, "kind string, id string, class string, words string" + kept)


def vectors(texts: DataFrame, order: Order) -> DataFrame:
    """``texts`` (class, words, ...) with a number, the cells and their places (see ``cells_of``), sketch and size.

    The number comes from the class, so it is the same in every session; two classes that share one cost a comparison.
    """
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def arrange(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import xxhash

        order, known = shared.value, {}
        places, depth, enough, unlisted = order.places, order.depth, order.enough, (0, order.rare, -1)
        for classes, batch in batches:
            if len(known) > 10 * RANKED:
                known = {}
            rows = []
            for name, words in zip(classes, batch):
                keyed = []
                for c in coordinates(words.split(" ")):
                    k = known.get(c)
                    if k is None:
                        h = xxhash.xxh64_intdigest(c.encode("utf-8", "replace"))
                        place, bits, part = places.get(c, unlisted)
                        k = known[c] = (place, h, bits, part if part >= 0 else h % PARTS)
                    keyed.append(k)
                keyed.sort()
                cells, at = cells_of(keyed, depth, enough)
                rows.append((signed(int(name[:16], 16)), np.array(cells, np.uint64).view(np.int64), np.array(at, np.int32), *parities([k[1] for k in keyed]), len(keyed)))
            yield pd.DataFrame(rows, columns=["vid", "leading", "at", "s0", "s1", "s2", "s3", "size"])

    udf = F.pandas_udf(arrange, VECTOR)
    return texts.withColumn("v", udf("class", "words")).select("*", "v.*").drop("v")


def filed(vecs: DataFrame, *more: str) -> DataFrame:
    """The cells in which vectors are filed, or which they probe."""
    spread = vecs.select("vid", "size", "s0", "s1", "s2", "s3", *more, F.explode(F.arrays_zip("leading", "at")).alias("x"))
    return spread.select("vid", "size", "s0", "s1", "s2", "s3", *more, F.col("x.at").alias("pos"), F.col("x.leading").alias("cell"))


def needed(q: str, x: str) -> Column:
    """So many coordinates two vectors within the distance have in common."""
    return F.ceil(F.greatest(f"{q}.size", f"{x}.size") * SHARE - 1e-9)


def within_bounds(q: str, x: str) -> Column:
    """Whether the bounds by length, by place and by sketch leave it open that two vectors that meet in a cell are near."""
    need = needed(q, x)
    flipped = sum((F.bit_count(F.col(f"{q}.s{i}").bitwiseXOR(F.col(f"{x}.s{i}"))) for i in range(4)), F.lit(0))
    return (
        (F.least(f"{q}.size", f"{x}.size") >= need)
        & (1 + F.least(F.col(f"{q}.size") - F.col(f"{q}.pos") - 1, F.col(f"{x}.size") - F.col(f"{x}.pos") - 1) >= need)
        & (flipped <= F.col(f"{q}.size") + F.col(f"{x}.size") - 2 * need)
    )


@F.pandas_udf(BooleanType())
def same(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([repeats(x.split(" "), y.split(" ")) for x, y in zip(a, b)], dtype=bool)


class History:
    """Accepted texts and delivered ids in a folder, in generations of bucketed files.

    ``create`` starts one, ``open`` goes on with one, ``ingest`` compares a batch and accepts what repeats nothing,
    ``compact`` merges the generations under a new order of cells. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        ship(spark)
        self.spark, self.root = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.version, self.generations, self.places, self.buckets = 0, 0, None, 0
        self.ws = Workspace(spark, "probe")

    # -- state on disk

    @classmethod
    def create(cls, spark: SparkSession, path: str, buckets: int | None = None) -> "History":
        """A new history; without ``buckets`` their number follows from the first batch."""
        self = cls(spark, path)
        if self._fs.exists(self._path(self.root)) and self._fs.listStatus(self._path(self.root)):
            raise FileExistsError(path)
        self.buckets = buckets or 0
        return self

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "History":
        self = cls(spark, path)
        self.version = max((int(s.getPath().getName()[1:]) for s in self._fs.globStatus(self._path(f"{self.root}/v*")) if self._fs.exists(self._path(f"{s.getPath()}/done/000000"))), default=-1)
        if self.version < 0:
            raise FileNotFoundError(path)
        while self._fs.exists(self._path(self._at(f"done/{self.generations:06d}"))):
            self.generations += 1
        kept = spark.read.schema(ORDER).parquet(self._at("order")).collect()
        rule = next(r for r in kept if r["c"] is None)
        self.buckets = rule["buckets"]
        # a history from before cells of several coordinates has none of the rule
        self.places = Order({r["c"]: (r["place"], r["bits"] or 0.0, -1 if r["part"] is None else r["part"]) for r in kept if r["c"] is not None}, rule["depth"] or 1, rule["enough"] or 0.0, rule["bits"] or 0.0)
        return self

    def _at(self, what: str) -> str:
        return f"{self.root}/v{self.version}/{what}"

    def _keep_order(self, texts: DataFrame, cells_a_text: int = LEAST_WORDS // 5 + 1) -> None:
        """Fix the order of coordinates and the number of buckets, for good."""
        n = texts.count()
        self.places = order = arranged(texts, n)
        if not self.buckets:
            self.buckets = min(BUCKETS[1], max(BUCKETS[0], n * cells_a_text * (2 * order.depth - 1) // CELLS_A_BUCKET))
        rows = [(None, 0, order.rare, None, self.buckets, order.depth, order.enough), *((c, *p, self.buckets, None, None) for c, p in order.places.items())]
        self.spark.createDataFrame(rows, ORDER).coalesce(1).write.mode("overwrite").parquet(self._at("order"))

    def _bucket(self, c: Column | str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _file(self, shelf: str, rows: DataFrame, by: str) -> None:
        names = [x.split()[0] for x in SHELVES[shelf].split(", ")]
        rows = rows.withColumn("bucket", self._bucket(by)).select(*names).repartition("bucket").sortWithinPartitions("bucket", by)
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(self._at(f"{shelf}/generation={self.generations:06d}"))

    def shelf(self, name: str, touched: list[int] | None = None) -> DataFrame:
        """What the complete generations hold, or their touched buckets alone: no other file is opened."""
        parts = [at for g in range(self.generations) if self._fs.exists(self._path(at := self._at(f"{name}/generation={g:06d}")))]
        if not parts:
            return self.spark.createDataFrame([], SHELVES[name])
        whole = self.spark.read.schema(SHELVES[name] + ", generation int").option("basePath", self._at(name)).parquet(*parts).drop("generation")
        return whole if touched is None or len(touched) >= self.buckets else whole.where(F.col("bucket").isin(touched))

    def _touched(self, rows: DataFrame, by: str) -> list[int] | None:
        """The buckets that rows touch; not looked for where there are few."""
        if self.buckets <= FEW_BUCKETS:
            return None
        return sorted(r[0] for r in rows.select(self._bucket(by).alias("b")).distinct().collect())

    # -- batches

    def ingest(self, records: DataFrame) -> DataFrame:
        """(kind, id_a, id_b) of the records (kind, key, id, text, arrived) of one batch that repeat an earlier one, by id or text.

        The rest is accepted. Of a key that comes twice in the batch the first arrival counts; rows without a key are left
        out, and null and short texts repeat nothing. Texts of one batch are not compared with each other; rejected ones
        are not kept, but their ids are. An empty batch gives no rows and leaves the history as it was.
        """
        ws = self.ws
        once = records.where("key IS NOT NULL").groupBy("kind", "key").agg(F.min_by(F.struct("text", "id"), F.struct("arrived", "text", "id")).alias("f")).select("kind", "key", F.col("f.id").alias("id"), F.col("f.text").alias("text"))
        batch, n = ws.save(once, "batch")
        if not n:
            return self.spark.createDataFrame([], "kind string, id_a string, id_b string")
        small = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df
        keys = batch.select("kind", "key")
        if self.generations:
            ids = self.shelf("ids", self._touched(keys, "key")).select("kind", "key", F.col("id").alias("old"))
            known, n_known = ws.save(ids.join(small(keys, n), ["kind", "key"]), "known")
            fresh = batch.join(small(known.select("kind", "key"), n_known), ["kind", "key"], "left_anti") if n_known else batch
        else:
            known, n_known, fresh = None, 0, batch
        texts, n_texts = ws.save(prepared(fresh.where("text IS NOT NULL")), "texts")
        if self.places is None:
            self._keep_order(texts)
        classes = texts.groupBy("class").agg(F.min("kind").alias("kind"), F.min("words").alias("words"))
        new, n_new = ws.save(vectors(classes, self.places), "vectors", measure=F.sum(F.size("leading")))
        hits, n_hits = self._matches(new, n_new, small) if self.generations and n_new else (None, 0)
        pairs = []
        if n_known:
            pairs.append(known.select("kind", F.col("old").alias("id_a"), F.col("old").alias("id_b")))
        if n_hits:
            old = self.shelf("members", self._touched(hits, "accepted")).select(F.col("class").alias("accepted"), F.col("id").alias("id_old"))
            near = old.join(small(hits, n_hits), "accepted").join(texts.select("class", "id"), "class")
            pairs.append(near.select("kind", F.least("id", "id_old").alias("id_a"), F.greatest("id", "id_old").alias("id_b")))
        found = None
        if pairs:
            found, _ = ws.save(pairs[0].unionByName(pairs[1]) if len(pairs) > 1 else pairs[0], "pairs")
        apart = lambda df: df.join(small(hits.select("class").distinct(), n_hits), "class", "left_anti") if n_hits else df
        filing = [("ids", fresh, "key")]
        if n_new:
            accepted = apart(new)
            filing += [("texts", accepted, "vid"), ("cells", filed(accepted), "cell"), ("members", apart(texts), "class")]
        self._file_all(filing)
        ws.drop(batch, texts, new, *(t for t in (known, hits) if t is not None))
        return found if found is not None else self.spark.createDataFrame([], "kind string, id_a string, id_b string")

    def _file_all(self, filing: list[tuple[str, DataFrame, str]]) -> None:
        """File the rows of a generation, the shelves at the same time, and mark it complete."""
        with ThreadPoolExecutor(len(filing)) as pool:
            for done in [pool.submit(self._file, *f) for f in filing]:
                done.result()
        self._fs.create(self._path(self._at(f"done/{self.generations:06d}"))).close()
        self.generations += 1

    def _matches(self, new: DataFrame, n_new: int, small) -> tuple[DataFrame, int]:
        """(kind, class, accepted): the accepted classes that the classes of ``new``, which probe ``n_new`` cells, repeat."""
        probes = filed(new)
        q, x = probes.alias("q"), self.shelf("cells", self._touched(probes, "cell")).alias("x")
        met = (
            x.join(small(q, n_new), F.col("q.cell") == F.col("x.cell"))
            .where(within_bounds("q", "x"))
            .select(F.col("q.vid").alias("vid"), F.col("x.vid").alias("met"))
            .distinct()
        )
        met, n_met = self.ws.save(met, "met")
        if not n_met:
            return met, 0
        right = self.shelf("texts", self._touched(met, "met")).select(F.col("vid").alias("met"), F.col("class").alias("accepted"), F.col("kind").alias("xkind"), F.col("words").alias("xw"))
        left = new.select("vid", "kind", "class", F.col("words").alias("qw"))
        near = right.join(small(met, n_met), "met").join(small(left, n_new), "vid").where("kind = xkind")
        found = self.ws.save(near.where(same("qw", "xw")).select("kind", "class", "accepted"), "hits")
        self.ws.drop(met)
        return found

    def compact(self) -> None:
        """All generations as one, in the order of coordinates and with the buckets that the accepted texts call for now.

        Words that were unknown at first count as the rarest; where they have grown common, this gives them their place.
        """
        ids, texts, members = (self.shelf(s) for s in ("ids", "texts", "members"))
        before, self.version = self.version, self.version + 1
        generations, self.generations, self.buckets = self.generations, 0, 0
        self._fs.delete(self._path(f"{self.root}/v{self.version}"), True)
        self._keep_order(texts)
        new, _ = self.ws.save(vectors(texts.select("class", "kind", "words"), self.places), "vectors")
        self._file_all([("ids", ids, "key"), ("texts", new, "vid"), ("cells", filed(new), "cell"), ("members", members, "class")])
        self.ws.drop(new)
        if generations:
            self._fs.delete(self._path(f"{self.root}/v{before}"), True)

    def remove(self) -> None:
        """Delete the folder."""
        self._fs.delete(self._path(self.root), True)


def near_classes(new: DataFrame, n_new: int, n_cells: int, ws: Workspace) -> tuple[DataFrame, int]:
    """(class, old, first, old_first): the classes of ``new`` that repeat one which came before the last batch of theirs.

    ``new`` has ``n_new`` vectors (see ``vectors``) in ``n_cells`` cells, with the first and the last batch of each class.
    A class that comes again is among its own. The cells are joined in rounds, so that those of one round are all that is
    shuffled at a time.
    """
    # both sides read the same columns under the same filters (none is inferred from within coalesce), so that one shuffle serves both
    earlier = F.coalesce(F.expr("x.first < q.last AND least(q.first, x.last) IS NOT NULL"), F.lit(False))
    rounds = math.ceil(min(n_cells / ROUND_CELLS, n_cells / n_new / ROUND_CELLS_A_TEXT)) or 1
    met, n = [], 0
    for r in range(rounds):
        cells = filed(new, "first", "last").where(F.pmod("cell", F.lit(rounds)) == r)
        pairs = cells.alias("q").join(cells.alias("x"), F.col("q.cell") == F.col("x.cell")).where(within_bounds("q", "x")).where(earlier)
        one, n_one = ws.save(pairs.select(F.col("q.vid").alias("vid"), F.col("x.vid").alias("old_vid")).distinct(), "met")
        met.append(one)
        n += n_one
        if rounds > 1:
            free_shuffles(new)
    if not n:
        return met[0], 0
    small = lambda df, most: F.broadcast(df) if n <= most else df
    whole = new.select("vid", "class", "kind", "words", "first", "last")
    left = small(ws.read(met).distinct(), BROADCAST_ROWS).join(whole, "vid").alias("q")
    near = small(left, BROADCAST_TEXTS).join(whole.alias("x"), F.col("old_vid") == F.col("x.vid"))
    near = near.where("q.kind = x.kind AND x.first < q.last").where(same("q.words", "x.words"))
    found = ws.save(near.select("q.class", F.col("x.class").alias("old"), "q.first", F.col("x.first").alias("old_first")), "near")
    ws.drop(*met)
    return found


def free_shuffles(df: DataFrame) -> None:
    """Let Spark delete the shuffle files that no query needs any longer: it does so once the driver's garbage is collected."""
    df.sparkSession.sparkContext._jvm.System.gc()


def repeated_records(records: DataFrame, ws: Workspace) -> DataFrame:
    """(kind, id_a, id_b) of the records (kind, key, id, text, batch, arrived) that repeat an earlier batch, by id or text.

    The result is that of a ``History`` which ingests the batches one after the other, but all texts are met at once:
    which of them are near does not depend on what is accepted, so only the pairs found go through the batches in turn.
    ``text`` is null where texts are not compared. Records without key or batch are left out. An empty input gives no rows.
    """
    ship(records.sparkSession)
    keyed = records.where("key IS NOT NULL AND batch IS NOT NULL").groupBy("kind", "key")
    once = keyed.agg(F.min_by(F.struct("text", "id"), F.struct("batch", "arrived", "text", "id")).alias("f"), F.min("batch").alias("batch"), F.max("batch").alias("last"))
    stored, n = ws.save(once.select("kind", F.col("f.id").alias("id"), F.col("f.text").alias("text"), "batch", "last"), "records")
    again, _ = ws.save(stored.where("last > batch").select("kind", F.col("id").alias("id_a"), F.col("id").alias("id_b")), "again")
    if not n:
        return again
    texts, n_texts = ws.save(prepared(stored.where("text IS NOT NULL"), "batch"), "texts")
    ws.drop(stored)
    free_shuffles(texts)
    if not n_texts:
        return again
    order = arranged(texts, n_texts)
    classes = texts.groupBy("class").agg(*(F.min(c).alias(c) for c in ("kind", "words")), F.min("batch").alias("first"), F.max("batch").alias("last"))
    new, n_cells = ws.save(vectors(classes, order), "vectors", measure=F.sum(F.size("leading")))
    ids, _ = ws.save(texts.select("kind", "class", "id", "batch"), "ids")
    ws.drop(texts)
    free_shuffles(new)
    near, n_near = near_classes(new, n_texts, n_cells, ws)
    ws.drop(new)
    if not n_near:
        return again
    small = lambda df: F.broadcast(df) if n_near <= BROADCAST_ROWS else df
    rejected: list[DataFrame] = []

    def accepted() -> DataFrame:
        """The pairs whose earlier class is accepted, as far as the batches have been gone through."""
        return near.join(small(ws.read(rejected).withColumnRenamed("class", "old")), "old", "left_anti") if rejected else near

    for b in sorted(r[0] for r in near.where("old_first < first").select("first").distinct().collect()):
        rejected.append(ws.save(accepted().where((F.col("first") == b) & (F.col("old_first") < b)).select("class").distinct(), "rejected")[0])
    pairs = ids.join(small(accepted()), "class").where("batch > old_first")
    members = ids.select(F.col("class").alias("old"), F.col("batch").alias("old_first"), F.col("id").alias("old_id"))
    by_text = pairs.join(members, ["old", "old_first"]).select("kind", F.least("id", "old_id").alias("id_a"), F.greatest("id", "old_id").alias("id_b"))
    return again.unionByName(by_text).distinct()
