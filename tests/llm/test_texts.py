import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, encode, leaks, quality, residue
from tidemark.llm.sampling import smallest_hashes

RANKS = f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken"
needs_ranks = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary")
ODD = [None, "", "   ", "plain words", "<unk> ▁ <|endoftext|> \x00", "你好 мир 👩‍👩‍👧 é́", "a" * 50_000, " " * 999, "it's 12345 o'clock\n\n\tnow"]


@needs_ranks
def test_ids_decode_and_agree_with_the_public_encoder(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    public = tiktoken.Encoding("own", pat_str=encode.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD * 2)], "doc_id int, text string, ids string")
    codec = encode.Codec.of(encode.serialise(encode.read_ranks(RANKS)), encode.PATTERN)
    for r in encode.encode_corpus(df, "text", RANKS).collect():
        assert r["ids"] == (public.encode_ordinary(r["text"]) if r["text"] else [])
        assert codec.decode(r["ids"]) == (r["text"] or "")
    assert encode.encode_corpus(df.limit(0), "text", RANKS).count() == 0


def test_leaks_against_brute_force(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["a", "I", "half-year", "$5.10", "Déjà"]
    passages = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 14, 15, 16, 40])))) for i in range(20)] + [(20, None), (21, ""), (22, "x y"), (0, None)]
    docs = []
    for d in range(120):
        words = [rnd.choice(vocab) for _ in range(30)]
        p = (rnd.choice(passages)[1] or "").split()
        n = rnd.choice([0, 13, 14, 15, 16, 30])
        at = rnd.randrange(max(1, len(p) - n + 1))
        piece = [rnd.choice([str.upper, str, lambda w: f"**{w}**", lambda w: w + ","])(w) for w in p[at : at + n]]
        docs.append((d, rnd.choice([" ", "\n> ", "  "]).join(words[:15] + piece + words[15:])))
    docs += [(200, None), (201, ""), (202, "long " * 20_000 + passages[0][1])]

    def words_of(t):
        return [w for w in map(leaks.squeeze, leaks.fold(t or "").split()) if w]

    want = set()
    for d, t in docs:
        runs = {tuple(w[i : i + 15]) for w in [words_of(t)] for i in range(len(w) - 14)}
        for i, p in passages:
            w = words_of(p)
            if any(tuple(w[j : j + 15]) in runs for j in range(len(w) - 14)):
                want.add((d, i))
    dd = spark.createDataFrame(docs + docs[:5], "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    ii = spark.createDataFrame(passages, "item_id bigint, passage string")
    got = [tuple(r) for r in leaks.leaks(dd, "doc_id", "text", ii, "item_id", "passage").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10
    assert leaks.leaks(dd, "doc_id", "text", ii.limit(0), "item_id", "passage").count() == 0
    assert leaks.leaks(dd.limit(0), "doc_id", "text", ii, "item_id", "passage").count() == 0


def test_leaks_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(leaks, "WORDS_PER_PASS", 5)
    passages = [(i, " ".join(f"p{i}x{j}" for j in range(18))) for i in range(4)]
    docs = spark.createDataFrame([(i, "before " + p + " after") for i, p in passages], "doc_id bigint, text string")
    got = leaks.leaks(docs, "doc_id", "text", spark.createDataFrame(passages, "item_id bigint, passage string"), "item_id", "passage")
    assert sorted(tuple(r) for r in got.collect()) == [(i, i) for i in range(4)]


PROSE = ["The board wants to raise money this year, and I do not think that it is enough for them.", "i would wait for the report before you buy it because they have been wrong about this", "WHY DID THIS MOVE SO MUCH AFTER THE CLOSE? I AM STILL NERVOUS ABOUT IT."]
LISTS = ["\n".join(f"* entry {w}" for w in "alpha beta gamma delta omega".split()), "1. Cash Pile 2. Order Book 3. Net Debt 4. Float 5. Backlog", "\n".join(f"https://img{i}.example/abc{i}" for i in range(5))]
TABLES = ["\n".join(f"| ABC{c} | {i} | {i * 7}.5 |" for i, c in enumerate("XYZWV")), "\n".join(f"SYM{c}\t{i}\t{i}.25\t+1.1%" for i, c in enumerate("XYZWV"))]
JUNK = ["a8f0 " * 3 + "dGhpcyBpcyBub3QgcHJvc2UgYXQgYWxs" * 6, "!!??##@@%%^^&&**(())" * 5, "buy " * 40, "¿¬â€™Ã¾»Ðœ " * 12]


def test_quality_separates_prose(spark):
    texts = [(k, i, t) for k, ts in (("prose", PROSE), ("list", LISTS), ("table", TABLES), ("junk", JUNK)) for i, t in enumerate(ts)]
    many = [(k, i, t) for k, i, t in texts for _ in range(8)] + [("null", 0, None), ("empty", 0, ""), ("blank", 0, " \n "), ("long", 0, PROSE[0] * 2000)]
    df = spark.createDataFrame(many, "k string, i int, text string").withColumn("quality", F.lit(1))
    rows = quality.text_quality(df, F.col("text")).collect()
    assert len(rows) == len(many)
    for r in rows:
        if r["k"] in ("prose", "empty", "blank", "long"):
            assert r["quality"]["prose"] > 0.5, r
        elif r["k"] == "null":
            assert r["quality"] is None
        else:
            assert r["quality"]["prose"] < 0.5, r
    q = {r["k"]: r["quality"] for r in rows}
    assert (q["empty"]["words"], q["empty"]["mean_word_length"], q["blank"]["symbol_ratio"]) == (0, 0.0, 0.0)
    assert q["prose"]["common_words"] > 0.3 and q["prose"]["closed_lines"] == 1.0
    assert quality.text_quality(df.limit(0), F.col("text")).count() == 0


def test_statistics():
    assert quality.statistics("One two!\nthree four five") == (24, 5, pytest.approx(19 / 5), pytest.approx(1 / 20), 0.5, pytest.approx(0.2))


RESIDUE = [
    "Error 404: page not found. Please try again later.", "503 Service unavailable", "JavaScript is disabled in your browser.", "You need to enable JavaScript to run this app.", "Hi {{ name }}, here is your summary for {{ day }}.",
    "Our target for [your price] is now [your date].", "Posted by %%author%% in %%board%%.", "Lorem ipsum dolor ament elis lorem ipsum dolor.", "Your headline goes here.", '{"error": {"code": 500, "message": "internal server error"}}',
]
TALK = ["Error 404 is a fair summary of the order book.", "You have to enable JavaScript to see their chart, so I gave up on it.", "I wrote a placeholder in my notes and forgot to fill it in.", "Their site was down for maintenance on Friday.", "The filing says [sic] that it is cheap, and <b>that</b> is all."]


def corpus():
    rnd = random.Random(1)
    nouns, verbs = ["the board", "my broker", "the market", "a friend", "the fund"], ["sold", "bought", "likes", "doubts", "reads"]
    talk = lambda: " ".join(f"{rnd.choice(nouns).capitalize()} {rnd.choice(verbs)} {rnd.choice(nouns)} after {rnd.randrange(99)} days." for _ in range(rnd.randrange(1, 4)))
    rows = []
    for i in range(400):
        lines = [talk()]
        if i % 4 == 0:
            lines.insert(rnd.randrange(2), rnd.choice(RESIDUE))
        elif i % 4 == 1:
            lines[0] += " " + rnd.choice(TALK)
        rows.append((i, "\n\n".join(lines), f"host{i % 15}"))
    return rows


def test_residue_on_unseen_hosts(spark):
    rows = corpus() + [(1000, None, None), (1001, "", "h"), (1002, " \n ", None), (1003, "calm words " * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string").withColumn("line", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = {r["doc_id"] for r in residue.find_residue(df, "text", "source").collect()}
    want = {i for i, *_ in rows[:400] if i % 4 == 0}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 3 and not got & {1000, 1001, 1002, 1003}
    assert residue.find_residue(df.limit(0), "text", "source").count() == 0


#: Residue that bears no weak label, and texts that no line of the fixtures repeats.
UNLISTED = ["Access denied. Reference #18.2c", "Enable cookies to continue", "Hello {first_name}, your order ships soon"]


def test_residue_is_told_by_the_model():
    lines = [(x, h, int(residue.weak(x))) for _, t, h in corpus() for x in residue.lines_of(t)]
    model = residue.fit(lines)
    assert model.holdout["precision"] > 0.9 and model.holdout["recall"] > 0.9
    assert model.residue(UNLISTED).all() and not model.residue([None, "", " \n ", *TALK]).any()
    assert not any(map(residue.weak, TALK)) and not residue.weak(UNLISTED[0])
    alone = residue.fit([])  # examples made by rule keep it usable
    assert alone.residue(UNLISTED).all()


def test_residue_features_do_not_depend_on_neighbours():
    texts = ["One {{two}} three\n\nfour", "", None, "x" * 5000 + " __y__", "__", "\u2028 \x00 ok"]
    model = residue.fit([(x, "h", 1) for x in RESIDUE] + [(x, "h", 0) for x in TALK])
    together, owner = model.margins([t or "" for t in texts])
    apart = [model.margins([t or ""])[0] for t in texts]
    assert np.allclose(together, np.concatenate(apart)) and owner.tolist() == [i for i, a in enumerate(apart) for _ in a]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_residue_on_unseen_hosts_of_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = residue.fitted(docs, "text", "source")
    assert model.holdout["residue"] > 50 and model.holdout["recall"] >= 0.9 and model.holdout["precision"] >= 0.9, model.holdout
    texts = [r[0] for r in docs.where("text IS NOT NULL").select("text").collect()]
    found = model.residue(texts)
    unlabelled = [t for t, f in zip(texts, found) if f and not any(map(residue.weak, residue.lines_of(t)))]
    assert len(unlabelled) >= 5


def test_sample_is_filled_however_often_rows_repeat(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 900).cast("string"))).alias("v"))
    assert len(smallest_hashes(rows, "v", 250)) == 250
    whole = rows.distinct().orderBy(F.xxhash64("v"), "v").limit(250).collect()
    assert [r[0] for r in smallest_hashes(rows, "v", 250)] == [r[0] for r in whole]
    assert len(smallest_hashes(rows, "v", 5_000)) == 301 and smallest_hashes(rows.limit(0), "v", 5) == []


def rows_of(df, columns):
    plain = lambda x: round(x, 6) + 0.0 if isinstance(x, float) else tuple(x) if isinstance(x, list) else x
    return sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_run(spark, name):
    """Every query gives rows without repeats; those that SQL can express give the same."""
    sf = "/root/testdata/sf0.001"
    df = catalog.QUERIES[name](spark, sf)
    got = rows_of(df, df.columns)
    assert got and (len(got) == len(set(got)) or name in ("p2_quality", "p2_statistics"))
    if name in catalog.ORACLE:
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for t in ("submissions", "comments", "reddit_daily", "prices"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.execute(catalog.ORACLE[name])
        order = [[c[0] for c in want.description].index(c) for c in df.columns]
        plain = lambda x: round(x, 6) + 0.0 if isinstance(x, float) else x.date() if hasattr(x, "hour") else x
        assert got == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_line_model_on_unseen_texts(spark):
    """Fitted to half of the texts, the model gives the plain lines of the other half the label of their rule."""
    texts = sorted({r[0] for r in spark.read.parquet("/root/testdata/sf0.01/comments.parquet").where("length(body) >= 40").select("body").collect()})
    model = quality.LineModel.fit(texts[::2])
    right = ruled = 0
    for t in texts[1::2]:
        lines = quality.lines_of(t)
        for line, state in zip(lines, model.viterbi([quality.describe(x) for x in lines])):
            r = quality.rule(line)
            ruled += r >= 0
            right += r == state
    print("held-out lines", ruled, right / ruled)
    assert ruled > 1000 and right / ruled > 0.95
