"""Template residue, filler, error pages and script notices in place of content.

A text is judged line by line, and the model alone decides. Weak labels come from response statuses and from general
phrase families; they mark examples, not results. A logistic regression with an L2 penalty on hashed n-grams, shapes,
length and title features is fitted to a bounded sample of labelled lines. The hosts are split in three: on most of them
weights are fitted, on some the penalty is chosen, and the rest, unseen until then, validates the very model that is used.
A text is residue, or contains it, if any of its lines is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from http import HTTPStatus

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.sampling import shares, within
from tidemark.session import ship

#: Hashed feature space; the texts that are looked at for examples, and the lines of either label that take part.
BITS = 18
SAMPLE_TEXTS = 20_000
SAMPLE_LINES = {1: 6_000, 0: 16_000}
#: Residue lines are looked for in more and more of the corpus until there are so many of them.
LEAST_RESIDUE = 300
#: Longer texts and lines are judged like all others but not chosen for fitting.
SAMPLE_CHARS, SAMPLE_LINE_CHARS = 20_000, 2_000
PENALTIES = (1e-7, 3e-6)
EPOCHS, BATCH, RATE = 14, 512, 0.06
#: Share of the loss that the residue lines have; the examples made by rule weigh as much as so many lines of the corpus.
RESIDUE_WEIGHT, MADE_AS = 0.15, 100
#: The margin of a line of which nothing is known: no residue.
BIAS = -1.0
#: Characters judged together; a longer text makes a group by itself.
CHARS_AT_ONCE = 2_000_000
#: Runs of marks count by their first marks, words by their first letters, so that no feature is unbounded.
MARKS, LETTERS = 4, 24
#: So many features without weight are added to each line, which holds lines of a word or two back.
SHRINK = 25
#: Lines in which more of the tokens than this share equal one of the next two are repetitive.
REPETITIVE = 0.5

_REASONS = "|".join(sorted({re.escape(s.phrase).replace(r"\ ", " ") for s in HTTPStatus if s >= 400} | {"Page not found", "Access denied", "(?:Unknown|Server|Client|Network|Database|Application) error"}, key=len, reverse=True))
_NEEDED = r"(?:java ?script|cookies|scripts?)"
_ALLOW = r"(?:enabl|activ|aktiv|allow|autoris|unblock|turn(?:ing)? on|switch(?:ing)? on|habilit|accept|requir|need)"
#: Families of weak labels: forms of responses, syntaxes of template languages, customary wordings.
LABELS = {
    "status": [
        rf"(?i)^(?:HTTP/\d(?:\.\d)? )?(?:error|status|code|http)?\W{{0,3}}[45]\d\d\W{{1,3}}(?:{_REASONS})\b",
        rf"(?i)^(?:{_REASONS})(?:\W{{1,3}}[45]\d\d)?\W*$",
        r"(?i)^(?:error|erreur|fehler|errore|erro)\W{1,3}[45]\d\d(?:[.:,;!-]|\W*$)",
        r'(?i)"(?:code|status|status_?code|error)"\s*:\s*"?[45]\d\d\b',
        r"(?i)<(?:title|h1)>\W*(?:error\W+)?[45]\d\d\b",
        r"^Traceback \(most recent call last\)|^\s+File \"[^\"]+\", line \d+|^\s+at [\w.$<>]+\([\w.]+:\d+\)|^(?:[\w.]+\.)?[A-Z]\w+(?:Error|Exception): ",
    ],
    "notice": [
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>|\W*(?:please|you (?:need|have|must)|to (?:use|view|continue|see)|this (?:site|page|app|board|website)|we)\b.*){_ALLOW}\w*\W+(?:\w+\W+){{0,2}}?{_NEEDED}\b\W*(?:(?:to|in|and|for|or|on)\b[^,;]*)?\W*$",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*{_ALLOW}\w*\W+(?:\w+\W+){{0,2}}?{_NEEDED}\b",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*{_NEEDED}\W+(?:\w+\W+){{0,3}}?(?:enabled|disabled|blocked|required|allowed|off|supported|necessary)\b",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*(?:veuillez|bitte|por favor|si prega)\b.*\b{_ALLOW}\w*\W+(?:\w+\W+){{0,3}}?{_NEEDED}\b",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*(?:bitte )?(?:schalten|lassen) sie\b.*{_NEEDED}",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*(?:this|the|our) \w+ (?:does not|doesn't|do not|cannot|can't|will not|won't) \w+ without {_NEEDED}\b",
        rf"(?i)^(?=.{{0,160}}$)(?:<noscript>)?\W*your browser\b.{{0,40}}{_NEEDED}\b",
        r"(?i)^(?:<noscript>)?\W*(?:please )?(?:verify|confirm|prove|checking|check|verifying)\W+(?:if |that )?(?:you(?:r browser|r connection)?\b|the site connection)\W*(?:are |is )?(?:(?:not )?a (?:ro)?bot|(?:a )?human|before|secure)\b",
    ],
    "page": [
        rf"(?i)^(?=.{{0,160}}$)\W*(?:oops|whoops|sorry|uh.?oh)\b.*\b(?:page|request|server|permission|reload|refresh|again|session|log ?in)\b",
        r"(?i)^(?=.{0,160}$).*\b(?:go back|return) to (?:the |our )?(?:front|home|main|start|previous)[ -]?page\b",
        r"(?i)^(?=.{0,160}$)\W*(?:(?:the|your|our|this) )?(?:page|server|session|request|connection|site|service|content)\b.*\b(?:not be found|not found|unavailable|not available|timed out|expired|blocked|refused|maintenance)\b",
    ],
    "slot": [
        r"\{\{\{? ?[\w.]+ ?\}?\}\}|<%[=-]? ?[\w.]+ ?%>|\{% ?\w+ ?%\}|[$#]\{[\w.]+\}|%%\w+%%|(?:^|\s)%[A-Za-z_]{3,}%|@@\w+@@|(?:^|\s)__\w+__(?!\w)|\[\[\w+\]\]",
        r"(?i)[\[<{(](?:your|insert|enter|add)[ _]\w+(?:[ _]\w+)*[\]>})]|[\[<{][\w ]+ here[\]>}]",
        r"<[A-Z][A-Z_ ]{3,}>|<[a-z]+_[a-z_]+>|(?<![\w'\":{\\])\{(?:[a-z][a-z_]{2,}|[A-Z][A-Z_]{2,})\}",
        r"[$€£]X{2,}(?:[.,]X{2,})?(?!\w)|(?<!\w)(?:X{2}|Y{2})%",
    ],
    "filler": [
        r"(?i)(?:\b(?:lorem|ipsum|dolor|amet|consectetur|adipiscing|elit)\b.*){3}",
        r"(?i)\byour (?:\w+ ){1,3}(?:goes )?here\b|(?:^|[.!?:] )\W*(?:insert|type|enter|add|put|write) (?:\w+ ){1,7}here\b(?=.{0,160}$)",
        r"(?i)\b(?:dummy|sample|placeholder|filler) (?:text|copy|paragraph|content|sentence|headline|title)s?\b(?=\W*(?:$|[.,;:!(]|for\b|goes\b|only\b))",
        r"(?i)^(?:.*\W)?(text|words?|blah?|test|content|copy)\b(?:\W+\1\b){2}|^\W*(?:TODO|TBD|FIXME)\b",
    ],
}
WEAK = [re.compile(p) for ps in LABELS.values() for p in ps]
#: Labels that only lines of up to so many characters may bear, as their patterns say, are not looked for in longer ones.
SHORT = 160
WEAK_AT_ANY_LENGTH = [p for p in WEAK if not p.pattern.startswith(f"(?i)^(?=.{{0,{SHORT}}}$)")]

TOKEN = re.compile(r"[\r\n]+|_{2,}|[^\W\d_]+(?:_[^\W\d_]+)*|\d+|[^\w\s]+|_")


def weak(line: str) -> bool:
    """Whether a line bears a weak label."""
    return any(p.search(line) for p in (WEAK if len(line) <= SHORT else WEAK_AT_ANY_LENGTH))


def made_lines() -> list[str]:
    """Examples made by rule: standard statuses, slots in the syntaxes of template languages, customary notices.

    They keep the model usable where a corpus holds hardly any residue; they never take part in validation.
    """
    names = "name first_name user date title price city email company link amount product order_id".split()
    forms = ["{{%s}}", "{{ %s }}", "{%s}", "{%% %s %%}", "${%s}", "#{%s}", "<%%= %s %%>", "%%%%%s%%%%", "%%%s%%", "@@%s@@", "__%s__", "[[%s]]", "[%s]", "<%s>", "[your %s]", "[insert %s]", "<insert %s>", "{{{%s}}}"]
    hosts = ["Hello %s, welcome back.", "Dear %s,", "Your order %s was sent on %s.", "Thank you, %s", "%s has written about %s", "Read more about %s in %s."]
    out = []
    for i, f in enumerate(forms):
        for j, h in enumerate(hosts):
            slots = [f % (n if j % 2 else n.upper()).replace("_", " " if f[0] in "[<" and " " in f else "_") for n in (names[(i + j) % len(names)], names[(i + 3 * j + 1) % len(names)])]
            out.append(h % tuple(slots[: h.count("%s")]))
    for s in HTTPStatus:
        if s >= 400:
            out += [f"{s.value} {s.phrase}", f"HTTP/1.1 {s.value} {s.phrase}", f"Error {s.value}: {s.phrase.lower()}.", f"<html><head><title>{s.value} {s.phrase}</title></head><body><h1>{s.phrase}</h1></body></html>", f'{{"error": {{"code": {s.value}, "message": "{s.phrase}"}}}}']
            out += [f"{s.phrase}. Reference #{s.value}", f"{s.description}." if s.description else s.phrase]
    for verb in ("enable", "activate", "turn on", "allow"):
        for what in ("JavaScript", "cookies", "scripts"):
            out += [f"Please {verb} {what} to continue.", f"You need to {verb} {what} to view this page.", f"{verb.capitalize()} {what} in your browser.", f"{verb.capitalize()} {what} to continue", f"<noscript>You must {verb} {what}.</noscript>"]
    for what in ("JavaScript", "Scripts", "Cookies"):
        out += [f"{what} must be enabled.", f"{what} disabled in your browser.", f"{what} required to use this site."]
    out += ["Verify that you are human.", "Checking your browser before you continue.", "Please confirm you are not a robot.", "Access denied.", "Page not found", "Server error", "Traceback (most recent call last):", '  File "app.py", line 1, in main', "ValueError: no such name"]
    for what in ("text", "title", "headline", "summary", "content", "description"):
        out += [f"Your {what} goes here.", f"Insert {what} here.", f"Sample {what}.", f"Placeholder {what} only.", f"{what} {what} {what} {what} {what}", f"TODO: add {what}"]
    return out + ["Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Lorem ipsum lorem ipsum"]


class Words(dict):
    """Token -> number, with the hash and the shape of each numbered token."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.hashes, self.shapes = [0], [0]  # number 0 is the line end
        self["\n"] = 0

    def __missing__(self, t: str) -> int:
        if t[0] in "\r\n":
            return 0
        if t.isdigit():
            h, s = "#", 1
        elif t[0].isalpha():
            h, s = t.lower()[:LETTERS], 2 + (t[0].isupper()) + (t.isupper() and len(t) > 1) + 3 * ("_" in t)
        else:
            h = t[:MARKS]
            s = 8 + zlib.crc32(h.encode("utf-8", "replace")) % 100_003
        self[t] = n = len(self.hashes)
        self.hashes.append(zlib.crc32(h.encode("utf-8", "replace")) + 1)
        self.shapes.append(s)
        return n

    def look_up(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return ids, np.array(self.hashes, dtype=np.uint64)[ids], np.array(self.shapes, dtype=np.uint64)[ids]


#: Words held between batches; beyond that they are learnt anew.
HELD = 300_000
_words = Words()


def _bits(*parts: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(parts[0]), salt * 0x9E3779B97F4A7C15 & (2**64 - 1), dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, line, text of line): hashed n-grams of words and shapes with length and title features, of all lines of
    ``texts`` at once. Lines without tokens do not count; lines that mostly repeat themselves have each feature once."""
    tokens: list[str] = []
    bounds = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        tokens.append("\n")
        tokens += TOKEN.findall(t)
        bounds[i] = len(tokens)
    tokens += ["\n", "\n"]
    if len(_words) > HELD:
        _words.clear()
    ids, h, s = _words.look_up(tokens)
    inside = ids > 0
    first = inside & ~np.concatenate([[False], inside[:-1]])
    line = np.cumsum(first) - 1
    lines = int(first.sum())
    owner = np.searchsorted(bounds, np.flatnonzero(first), side="right")
    at = np.flatnonzero(inside)
    own = line[at]
    nxt, after, before = h[at + 1], h[np.minimum(at + 2, len(h) - 1)], h[at - 1]
    after = np.where(nxt == 0, 0, after).astype(np.uint64)
    s0, s1, s2 = s[at - 1], s[at], s[at + 1]
    opening = before == 0
    marked = (s1 >= 2) & (s1 < 8) & (s0 >= 8) & (s2 >= 8)
    size = np.bincount(own, minlength=lines)
    words = (s1 >= 2) & (s1 < 8)
    n_words = np.bincount(own, words, lines)
    capital = np.bincount(own, words & (s1 % 3 != 2), lines)
    shout = np.bincount(own, words & (s1 % 3 == 1), lines)
    bucket = np.where(size < 3, size, (np.log2(np.maximum(size, 1)) * 2).astype(np.int64))
    titled = np.where(n_words > 0, capital * 4 // np.maximum(n_words, 1) * 4 + np.minimum(n_words, 12) // 3, 99)
    shouted = np.where(n_words > 0, shout * 4 // np.maximum(n_words, 1), 99)
    u = lambda a: a.astype(np.uint64)
    per_line = np.arange(lines)
    features = np.concatenate([
        _bits(h[at], salt=1), _bits(h[at], nxt, salt=2), _bits(h[at], after, salt=3)[after > 0], _bits(s0, s1, s2, salt=4),
        _bits(nxt[opening], h[at][opening], salt=5), _bits(before[marked], s1[marked], nxt[marked], salt=6), _bits(h[at][marked], salt=7),
        _bits(u(bucket), salt=8), _bits(u(titled), salt=9), _bits(u(shouted), salt=10),
    ])
    lines_of_features = np.concatenate([own, own, own[after > 0], own, own[opening], own[marked], own[marked], per_line, per_line, per_line])
    again = np.bincount(own, (h[at] == nxt) | (h[at] == after), lines)
    repetitive = (again > REPETITIVE * size)[lines_of_features]
    if repetitive.any():
        once = np.unique(lines_of_features[repetitive] << BITS | features[repetitive])
        features = np.concatenate([features[~repetitive], once & (1 << BITS) - 1])
        lines_of_features = np.concatenate([lines_of_features[~repetitive], once >> BITS])
    return features, lines_of_features, owner


@dataclass
class Linear:
    """A linear classifier over hashed features of lines, each line scaled by its length; and how it did on unseen hosts."""

    weights: np.ndarray
    bias: float
    penalty: float = 0.0
    holdout: dict = field(default_factory=dict)

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(margin, text) of each line of ``texts``."""
        f, line, owner = line_features(texts)
        if not len(owner):
            return np.zeros(0), owner
        return np.bincount(line, self.weights[f], len(owner)) / np.sqrt(np.bincount(line, minlength=len(owner)) + SHRINK) + self.bias, owner

    def residue(self, texts: list[str | None]) -> np.ndarray:
        """Whether any line of each text is residue; null and blank texts are not."""
        z, owner = self.margins([t or "" for t in texts])
        found = np.zeros(len(texts), dtype=bool)
        found[owner[z > 0]] = True
        return found


def lines_of(text: str) -> list[str]:
    return [x for x in re.split(r"[\r\n]+", text) if x and not x.isspace()]


def fit_weights(rows: list[np.ndarray], y: np.ndarray, share: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by adaptive steps over batches of lines; ``share`` weighs the lines."""
    order = np.random.default_rng(7).permutation(len(rows))
    used, packed = np.unique(np.concatenate([rows[i] for i in order]), return_inverse=True)
    size = np.array([len(rows[i]) for i in order])
    ends = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(order)), size)
    scale = (1 / np.sqrt(size + SHRINK))[owner]
    y, share = y[order], share[order] * len(order) / share.sum()
    w, b = np.zeros(len(used)), BIAS
    m, v = np.zeros_like(w), np.zeros_like(w)
    mean_w, t, kept = np.zeros_like(w), 0, 0
    for epoch in range(EPOCHS):
        for start in range(0, len(order), BATCH):
            stop, t = min(start + BATCH, len(order)), t + 1
            part = slice(ends[start], ends[stop])
            cols, own, sc = packed[part], owner[part] - start, scale[part]
            z = np.bincount(own, w[cols] * sc, stop - start) + b
            err = share[start:stop] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[start:stop]) / BATCH
            g = np.bincount(cols, err[own] * sc, len(w)) + penalty * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            c1, c2 = 1 - 0.9**t, 1 - 0.999**t
            w -= RATE * (m / c1) / (np.sqrt(v / c2) + 1e-6)
            if epoch >= EPOCHS // 2:  # the mean of the later steps
                kept += 1
                mean_w += (w - mean_w) / kept
    full = np.zeros(1 << BITS)
    full[used] = mean_w
    return full, BIAS


def scores(z: np.ndarray, y: np.ndarray) -> dict:
    truth, said = y > 0, z > 0
    hit = int((truth & said).sum())
    share = np.where(truth, RESIDUE_WEIGHT / max(1, truth.sum()), (1 - RESIDUE_WEIGHT) / max(1, (~truth).sum()))
    return {"lines": len(y), "residue": int(truth.sum()), "precision": hit / max(1, int(said.sum())), "recall": hit / max(1, int(truth.sum())), "loss": float((share * np.logaddexp(0, np.where(truth, -z, z))).sum())}


def fit(lines: list[tuple[str, str | None, int]]) -> Linear:
    """The classifier of (line, host, label).

    Of five groups of hosts one validates the model and takes no part in anything else; of the other four, one chooses
    the penalty, and the model is then fitted to all four.
    """
    made = made_lines()
    texts = [re.sub(r"[\r\n]+", " ", x) for x, *_ in lines] + made
    f, line, owner = line_features(texts)
    at = np.argsort(line, kind="stable")
    ends = np.searchsorted(line[at], np.arange(len(owner) + 1))
    rows: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(texts)
    for i, o in enumerate(owner):
        rows[o] = f[at[ends[i] : ends[i + 1]]]
    y = np.array([label for *_, label in lines] + [1] * len(made), dtype=float)
    group = np.array([zlib.crc32((h or "").encode("utf-8", "replace")) % 5 for _, h, _ in lines] + [-1] * len(made))
    own = y * (group >= 0)

    def trained(part: np.ndarray, penalty: float) -> Linear:
        known = (own[part] > 0).sum()
        share = np.where(y > 0, RESIDUE_WEIGHT / (known + MADE_AS), (1 - RESIDUE_WEIGHT) / max(1, (y[part] == 0).sum()))
        share[group < 0] *= MADE_AS / len(made)
        return Linear(*fit_weights([rows[i] for i in part], y[part], share[part], penalty), penalty)

    def judged(model: Linear, part: np.ndarray) -> dict:
        return scores(np.array([model.weights[rows[i]].sum() / np.sqrt(len(rows[i]) + SHRINK) + model.bias for i in part]), y[part])

    choose, train = np.flatnonzero(group == 1), np.flatnonzero(group != 0)
    penalty = PENALTIES[0]
    if (y[choose] > 0).any() and (y[choose] == 0).any():
        penalty = min(PENALTIES, key=lambda p: judged(trained(np.flatnonzero((group != 0) & (group != 1)), p), choose)["loss"])
    model = trained(train, penalty)
    model.holdout = judged(model, np.flatnonzero(group == 0))
    return model


def labelled_lines(docs: DataFrame, text: str, host: str) -> list[tuple[str, str | None, int]]:
    """At most SAMPLE_LINES distinct lines of either label, drawn by hashes of line and text, so that lines of many
    texts are likelier, from about SAMPLE_TEXTS texts. The same lines come out however the rows are spread.

    Other lines of texts that hold residue are left out, as they may belong to it. Where residue is so rare that fewer than
    LEAST_RESIDUE lines of it come out, more texts are searched for it, all of them in the end.
    """

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, h in zip(batch["text"], batch["host"]):
                lines = [x for x in lines_of(t) if len(x) <= SAMPLE_LINE_CHARS]
                found = [weak(x) for x in lines]
                out += [(x, h, int(w), zlib.crc32(f"{x}\n{t}".encode("utf-8", "replace"))) for x, w in zip(lines, found) if w or not any(found)]
            yield pd.DataFrame(out, columns=["line", "host", "label", "h"])

    ship(docs.sparkSession)
    texts = docs.select(F.col(text).alias("text"), F.col(host).cast("string").alias("host")).where(F.length("text") <= SAMPLE_CHARS)
    drawn: dict[int, list] = {0: [], 1: []}
    for step, share in enumerate(shares(docs.count(), SAMPLE_TEXTS, 1)):
        once = texts.where(within("text", share)).groupBy("text").agg(F.min("host").alias("host"))
        found = once.mapInPandas(label, "line string, host string, label int, h long")
        if step:  # only residue is short
            found = found.where("label = 1")
        lines = found.groupBy("label", "line").agg(F.min("host").alias("host"), F.min("h").alias("h"))
        place = F.row_number().over(Window.partitionBy("label").orderBy("h", "line"))
        picked = lines.withColumn("n", place).where(F.col("n") <= max(SAMPLE_LINES.values())).collect()
        for which in (1,) if step else (0, 1):
            drawn[which] = [(r["line"], r["host"], which) for r in sorted((r for r in picked if r["label"] == which), key=lambda r: r["n"])][: SAMPLE_LINES[which]]
        if len(drawn[1]) >= LEAST_RESIDUE:
            break
    return drawn[1] + drawn[0]


def fitted(docs: DataFrame, text: str, host: str) -> Linear:
    """The classifier of a corpus, with its figures on unseen hosts in ``holdout``."""
    return fit(labelled_lines(docs, text, host))


def find_residue(docs: DataFrame, text: str, host: str) -> DataFrame:
    """The rows of ``docs`` whose text is, or contains as a line of its own, page residue.

    Null, empty and blank texts are none; an empty table gives no rows. The weights (2**BITS numbers, whatever the corpus)
    are broadcast, and the rows are judged where they are, all lines of an Arrow batch at once.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, text, host))

    @F.pandas_udf("boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, found = batch.tolist(), []
            start, held = 0, 0
            for i, t in enumerate(texts):  # long texts make small groups
                held += len(t or "")
                if held > CHARS_AT_ONCE or i + 1 == len(texts):
                    found.append(model.value.residue(texts[start : i + 1]))
                    start, held = i + 1, 0
            yield pd.Series(np.concatenate(found) if found else np.zeros(0, dtype=bool))

    return docs.where(judge(F.col(text)))
