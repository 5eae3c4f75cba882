"""Statistics of each text and the share of its characters that is running prose.

Each line is described by statistics in coarse steps. A hidden Markov model with the states prose, list, table and junk
emits them; it is fitted on a bounded sample of texts whose plain lines are labelled by rules (the model then also
judges lines that no rule covers, from their statistics and their neighbours). Viterbi labels the lines, and the label
shares by characters are the text's.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import smallest_hashes
from tidemark.session import ship

STATES = ("prose", "list", "table", "junk")
#: Texts on which the model is fitted: those with the smallest hashes, never more; longer ones than SAMPLE_CHARS are not chosen.
SAMPLE_TEXTS = 6_000
SAMPLE_CHARS = 20_000
#: Lines of a sampled text that take part in fitting.
SAMPLE_LINES = 40
ROUNDS = 3

#: Function words of the languages at hand.
COMMON = frozenset(
    """a about after all am an and any are as at be because been before but by can could did do does down even every for from had has have he her here
    his how i if in into is it its just like long me more my no not now of off on once one only or other our out over right she should since so some
    still than that the their them then there they this those to too under until up was we were what when where whereas which while who why will
    with would yet you your al con de del el en es la las lo los más no para pero por que se si su un una y das dem den der die ein eine für ich
    im ist mit nicht sich und von wie zu au aux ce ces cette dans des du est et je le les ne pas plus pour qui sur une""".split()
)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
URL = re.compile(r"(?:https?://|www\.)\S+")
MARKER = re.compile(r"\s*(?:([-*•·‣▪–—+>])|(\d{1,3}[.)])|(\(?[a-zA-Z][.)]))\s+\S")
PAIR = re.compile(r"\s*[^\s:][^:]{0,40}:\s+\S[^.!?]{0,30}$")
RUNS = re.compile(r"\S {2,}(?=\S)")
ENTRY = re.compile(r"(?:[-*•·‣▪–—+|]|#?\d{1,3}[.)]|#\d{1,3}|[^\W\d_]+:)$").match
CLOSING = re.compile(r"[.!?…][\"'”’)\]*]*\s*$")
DIGIT = re.compile(r"\d").search
VOWELS, ACCENTED = "aeiouy", "áéíóúàèìòùâêîôûäëïöü"


def step(x: float, *bounds: float) -> int:
    return sum(x >= b for b in bounds)


def tokens_of(line: str) -> list[str]:
    return URL.sub(" ", line).split()


def inline(tokens: list[str]) -> int:
    """How far a line is a list written in a row: entries with a marker or a key each."""
    found = sum(map(bool, map(ENTRY, tokens[:-1])))
    return step(found / len(tokens), 0.1, 0.16) if found > 2 else 0


def columns(line: str) -> tuple[int, int]:
    """Marks that separate columns (tabs, bars, semicolons, wide gaps, commas without a blank), and slashes between words."""
    n = line.count("\t") + line.count("|") + line.count(";")
    if "," in line:
        n += line.count(",") - line.count(", ") - line.endswith(",")
    if "  " in line:
        n += len(RUNS.findall(line))
    return n, line.count(" / ")


def vowel_share(words: list[str]) -> float:
    joined = "".join(words)
    return sum(map(joined.count, VOWELS if joined.isascii() else VOWELS + ACCENTED)) / (len(joined) or 1)


def describe(line: str) -> tuple[int, ...]:
    """The statistics of one line, each as a small step number."""
    linked = "://" in line or "www." in line
    bare = URL.sub(" ", line) if linked else line
    tokens = bare.split()
    words = WORD.findall(bare.lower())
    n, nw, solid = len(tokens), max(1, len(words)), len("".join(line.split())) or 1
    letters = sum(map(len, words))
    plain = letters + sum(map(line.count, "0123456789")) + (len(line) - len(bare) if linked else 0)
    marker = MARKER.match(line)
    numbers = sum(map(bool, map(DIGIT, tokens)))
    longest = max(map(len, tokens), default=0)
    mixed = longest > 24 and any(len(t) > 24 and not t[1:].islower() for t in tokens)
    vowels = vowel_share(words)
    caps = sum(map(str.isupper, tokens))
    foreign = not line.isascii()
    odd = sum(ch > "\x7f" for ch in line) / solid if foreign else 0
    ascii_ = [w for w in words if w.isascii()] if foreign else words
    return (
        0 if not marker else 1 + next(i for i, g in enumerate(marker.groups()) if g),
        step(sum(columns(line.strip())), 1, 2, 4),
        step(sum(map(COMMON.__contains__, words)) / nw, 0.01, 0.12, 0.25, 0.4),
        step(numbers / max(1, n), 0.01, 0.2, 0.4, 0.7),
        step(1 - plain / solid, 0.05, 0.1, 0.2, 0.35),
        step(longest, 16, 25, 40),
        step(n, 1, 2, 4, 8, 16),
        step(len(set(words)) / nw if nw > 5 else 1, 0.3, 0.6),
        step(letters / solid, 0.4, 0.65),
        int(bool(CLOSING.search(line))),
        step(sum(map(len, URL.findall(line))) / solid if linked else 0, 0.01, 0.5),
        step(vowels, 0.12, 0.25),
        step(caps / max(1, n), 0.01, 0.3, 0.8),
        int(mixed),
        step(odd, 0.01, 0.3),
        int(bool(PAIR.match(line))),
        step(sum(map(len, ascii_)) / max(1, len(ascii_)), 2.2, 3.2, 7, 10),
        inline(tokens),
    )


STEPS = (4, 4, 5, 5, 5, 4, 6, 3, 3, 2, 3, 3, 4, 2, 3, 2, 5, 3)


def rule(line: str) -> int:
    """The state of a plain case, or -1."""
    tokens = tokens_of(line)
    words = WORD.findall(URL.sub(" ", line).lower())
    common = sum(w in COMMON for w in words) / max(1, len(words))
    solid = [ch for ch in line if not ch.isspace()]
    plain = sum(ch.isalnum() for ch in solid)
    if URL.search(line) and len(words) < 3:
        return 1
    if plain < 0.5 * len(solid) and common < 0.1 and not sum(columns(line.strip())):
        return 3
    if any(len(t) > 40 for t in tokens) and common < 0.1:
        return 3
    if len(tokens) > 7 and len(set(words)) < 0.3 * len(words):
        return 3
    if len(tokens) > 5 and all(len(t) == 2 for t in tokens) and common < 0.1:
        return 3
    if sum(ord(c) > 0x7F and not c.isspace() for c in solid) > 0.5 * len(solid) and not any(w.isascii() for w in words):
        return 3
    if len(words) > 4 and common < 0.05 and vowel_share(words) < 0.12 and not any(t.isupper() or any(c.isdigit() for c in t) for t in tokens):
        return 3
    cols, slashes = columns(line.strip())
    if len(tokens) > 7 and sum(any(c.isdigit() for c in t) for t in tokens) > 0.55 * len(tokens) and common < 0.1:
        return 2
    if inline(tokens) > 1 and common < 0.3:
        return 1
    if cols > 1 and common < 0.12 and not slashes:
        return 2
    if (MARKER.match(line) and len(tokens) < 9 or PAIR.match(line) and len(tokens) < 8 or cols + slashes > 2) and common < 0.4:
        return 1
    if len(words) > 4 and common >= 0.25 and not MARKER.match(line) and not cols + slashes:
        return 0
    return -1


def lines_of(text: str) -> list[str]:
    return [x for x in text.splitlines() if x and not x.isspace()]


class LineModel:
    """The hidden Markov model, as logarithms of probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        self.start, self.move, self.emit = start, move, emit
        self.scores: dict[tuple[int, ...], np.ndarray] = {}

    @classmethod
    def fit(cls, texts: list[str]) -> "LineModel":
        """Counts over rule-labelled lines, then ROUNDS of Viterbi training in which the rules stay fixed."""
        seqs = [lines_of(t)[:SAMPLE_LINES] for t in texts]
        seqs = [s for s in seqs if s]
        seen = [[describe(x) for x in s] for s in seqs]
        ruled = [[rule(x) for x in s] for s in seqs]
        model = cls.count(seen, ruled)
        for _ in range(ROUNDS):
            guessed = [[r if r >= 0 else g for r, g in zip(rs, model.viterbi(xs))] for rs, xs in zip(ruled, seen)]
            model = cls.count(seen, guessed)
        return model

    @classmethod
    def count(cls, seen: list[list[tuple[int, ...]]], labels: list[list[int]]) -> "LineModel":
        k = len(STATES)
        start, move, emit = np.ones(k), np.ones((k, k)) + 4 * np.eye(k), [np.full((k, n), 0.5) for n in STEPS]
        for xs, ys in zip(seen, labels):
            if ys[0] >= 0:
                start[ys[0]] += 1
            for a, b in zip(ys, ys[1:]):
                if a >= 0 and b >= 0:
                    move[a, b] += 1
            for x, y in zip(xs, ys):
                if y >= 0:
                    for e, v in zip(emit, x):
                        e[y, v] += 1
        return cls(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), [np.log(e / e.sum(1, keepdims=True)) for e in emit])

    def viterbi(self, xs: list[tuple[int, ...]]) -> list[int]:
        if not xs:
            return []
        best, back = self.start + self.score(xs[0]), []
        for x in xs[1:]:
            options = best[:, None] + self.move
            back.append(options.argmax(0))
            best = options.max(0) + self.score(x)
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def score(self, x: tuple[int, ...]) -> np.ndarray:
        known = self.scores.get(x)
        if known is None:
            known = self.scores[x] = sum(e[:, v] for e, v in zip(self.emit, x))
        return known

    def shares(self, text: str) -> list[float]:
        """The share of the characters in lines of each state; all prose where there are no lines."""
        lines = lines_of(text)
        sums = [0.0] * len(STATES)
        for line, state in zip(lines, self.viterbi([describe(x) for x in lines])):
            sums[state] += len(line.strip())
        total = sum(sums)
        return [s / total for s in sums] if total else [1.0, 0.0, 0.0, 0.0]


def statistics(text: str) -> tuple[int, int, float, float, float, float]:
    """Characters, words, mean word length, symbol ratio, share of lines that end in punctuation, share of common words."""
    words, lines = WORD.findall(text.lower()), lines_of(text)
    solid = len("".join(text.split()))
    symbols = solid - sum(map(str.isalnum, text))
    return (
        len(text),
        len(words),
        sum(map(len, words)) / len(words) if words else 0.0,
        symbols / solid if solid else 0.0,
        sum(bool(CLOSING.search(x)) for x in lines) / len(lines) if lines else 0.0,
        sum(w in COMMON for w in words) / len(words) if words else 0.0,
    )


SHARES = ", ".join(f"{s} double" for s in STATES)
RESULT = "chars int, words int, mean_word_length double, symbol_ratio double, closed_lines double, common_words double, " + SHARES


def sample(df: DataFrame, text: Column, least_chars: int) -> list[str]:
    """At most SAMPLE_TEXTS distinct texts, those with the smallest hashes (the same ones however the rows are spread)."""
    texts = df.select(text.alias("t"))
    fit = texts.where(F.length("t").between(least_chars, SAMPLE_CHARS))
    return [r[0] for r in smallest_hashes(fit, "t", SAMPLE_TEXTS)]


def text_quality(df: DataFrame, text: Column, least_chars: int = 40, counts: bool = True) -> DataFrame:
    """``df`` with a struct ``quality`` of RESULT, or of the label shares alone; null where the text is null.

    Empty and blank texts have zero counts and count as prose. One pass over the rows with the fitted model (a few
    kilobytes) broadcast; nothing is shuffled.
    """
    ship(df.sparkSession)
    fitted = df.sparkSession.sparkContext.broadcast(LineModel.fit(sample(df, text, least_chars)))
    result = RESULT if counts else SHARES
    names = [x.split()[0] for x in result.split(", ")]

    @F.pandas_udf(result)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(None,) * len(names) if t is None else (*(statistics(t) if counts else ()), *fitted.value.shares(t)) for t in batch]
            yield pd.DataFrame(rows, columns=names)

    return df.withColumn("quality", judge(text)).withColumn("quality", F.when(text.isNotNull(), F.col("quality")))
