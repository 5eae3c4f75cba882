"""Encoding a corpus with a public byte-level BPE vocabulary through a serialised sentencepiece model.

The model is written directly from the ranks of the vocabulary: each token becomes a piece in which every byte is
one printable character, scored by its negative rank, so that the library's merge order (best score first, leftmost
on ties) is the rank order. Normalisation is the identity. Texts are cut into pre-tokens by the vocabulary's pattern
before encoding; decoding maps ids to pieces and pieces back to bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

#: The pattern that splits text before the merges of the rank files (a fixed value of the public vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The unknown piece; mapped texts hold no private-use characters, so it never occurs in one.
UNKNOWN = "\ue000"
#: Distinct pre-tokens that a worker remembers before it starts afresh.
REMEMBERED = 400_000


@lru_cache(1)
def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it prints, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank) in rank order."""
    pairs = [line.split() for line in open(path, "rb") if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: length-delimited bytes, a varint or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; an unknown piece that no mapped text contains comes last."""
    table = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
    pieces = [(t.decode("latin-1").translate(table), -float(rank), 1) for rank, t in enumerate(tokens)] + [(UNKNOWN, 0.0, 2)]
    body = b"".join(_field(1, _field(1, p.encode()) + _field(2, score) + _field(3, kind)) for p, score, kind in pieces)
    trainer = _field(3, 2)  # model type BPE
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return body + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes with a serialised model; one per worker process."""

    held: dict[int, "Codec"] = {}

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_chars = str.maketrans({chr(b): c for b, c in enumerate(chars)})
        self.to_bytes = {c: b for b, c in enumerate(chars)}
        self.known: dict[str, list[int]] = {}

    @classmethod
    def of(cls, model: bytes, pattern: str) -> "Codec":
        key = hash((model, pattern))
        if key not in cls.held:
            cls.held = {key: cls(model, pattern)}
        return cls.held[key]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty texts have none, special tokens are ordinary text."""
        cut = [self.find(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list({p for pieces in cut for p in pieces if p not in self.known})
        mapped = [p.encode().decode("latin-1").translate(self.to_chars) for p in fresh]
        self.known.update(zip(fresh, self.model.encode(mapped, num_threads=1) if mapped else []))
        known = self.known
        return [[i for p in pieces for i in known[p]] for pieces in cut]

    def decode(self, ids: list[int]) -> str:
        chars = "".join(self.model.id_to_piece(list(ids))) if len(ids) else ""
        return bytes(self.to_bytes[c] for c in chars).decode("utf-8", "replace")


def encode_corpus(df: DataFrame, text: str, ranks_path: str, pattern: str = PATTERN, out: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text``: a list of integers, empty for null and empty texts.

    The model (some bytes per vocabulary entry, whatever the corpus) is broadcast once; the rows stay in place, so
    nothing is shuffled.
    """
    ship(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(model.value, pattern)
        for batch in batches:
            yield pd.Series(codec.encode(list(batch)), dtype=object)

    return df.withColumn(out, ids(F.col(text)))
