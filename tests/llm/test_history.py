import random

from pyspark.sql import functions as F

from tidemark.llm import history as H
from tidemark.session import Workspace

WORDS = [f"word{i}" for i in range(400)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_words_equals_dynamic_programming():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ([rnd.choice("abcdef") for _ in range(rnd.randrange(40))] for _ in range(2))
        assert H.common_words(a, b) == lcs(a, b)


def test_words_apart_from_form():
    assert H.words_of("The  shаre-count,​ FELL!  5%") == ["the", "sharecount", "fell", "5"]
    assert H.words_of(" ... ") == []


def edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        i = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[i] = rnd.choice(WORDS)
        elif kind == 1:
            out.insert(i, rnd.choice(WORDS))
        else:
            del out[i]
    return out


def records(rnd):
    base = [[rnd.choice(WORDS[: rnd.choice([60, 400])]) for _ in range(rnd.randrange(60, 140))] for _ in range(25)]
    rows = []
    for b in range(4):
        for i in range(30):
            words = edited(rnd, rnd.choice(base), rnd.choice([0, 3, 8, 14, 20, 30]))
            rows.append((f"c{b}{i:02d}", b, i, " ".join(words)))
    rows += [(f"same{b}", b, 0, " ".join(base[0])) for b in range(4)]
    rows += [(f"twin{b}{i}", b, i, " ".join(edited(random.Random(9), base[1], 4 * b))) for b in (1, 2, 3) for i in range(12)]
    rows += [("c000", 2, 5, "other text"), ("c001", 0, 99, "late"), ("short", 1, 0, "a b c"), ("null", 1, 0, None), ("empty", 1, 0, ""), ("null", 3, 0, None)]
    rows += [("flat", 1, 0, "the " * 100), ("flat2", 2, 0, "the " * 100), (None, 1, 0, "x"), ("nobatch", None, 0, "x")]
    return rows


def brute(rows):
    first, last = {}, {}
    for i, b, at, text in rows:
        if i is None or b is None:
            continue
        if i not in first or (b, at) < first[i][:2]:
            first[i] = (b, at, text)
        last[i] = max(last.get(i, b), b)
    again = {(i, i) for i in first if last[i] > first[i][0]}
    accepted, pairs = [], set()
    words = {i: H.words_of(t or "") for i, (_, _, t) in first.items()}
    fit = [i for i in first if len(words[i]) >= 60 and len(set(words[i])) >= 30]
    for b in sorted({first[i][0] for i in fit}):
        fresh = []
        for i in (i for i in fit if first[i][0] == b):
            hits = [j for j in accepted if lcs(words[i], words[j]) >= 0.8 * max(len(words[i]), len(words[j])) - 1e-9]
            pairs |= {(min(i, j), max(i, j)) for j in hits}
            if not hits:
                fresh.append(i)
        accepted += fresh
    return again | pairs


def test_batches_against_brute_force(spark):
    rows = records(random.Random(7))
    df = spark.createDataFrame(rows, "id string, batch int, arrived int, text string").select(F.lit("comment").alias("kind"), F.col("id").alias("key"), "*", F.lit(1).alias("vid"), F.lit("x").alias("class"))
    got = [(r["id_a"], r["id_b"]) for r in H.repeated_records(df, Workspace(spark, "t")).collect()]
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 40
    assert H.repeated_records(df.limit(0), Workspace(spark, "t")).count() == 0


def shaped(spark, rows, kind="comment"):
    df = spark.createDataFrame(rows, "id string, batch int, arrived int, text string")
    return df.select(F.lit(kind).alias("kind"), F.col("id").alias("key"), "*").where("batch IS NOT NULL")


def test_a_reopened_history_goes_on_and_reads_what_it_needs(spark, tmp_path):
    rows = records(random.Random(11))
    last = [r for r in rows if r[1] == 3]
    texts = [r for r in last if len(H.words_of(r[3] or "")) >= 60]
    df, at = shaped(spark, rows), f"file://{tmp_path}/h"
    history = H.History.create(spark, at, buckets=128)
    got = set()
    for b in range(3):
        got |= {(r["id_a"], r["id_b"]) for r in history.ingest(df.where(F.col("batch") == b)).collect()}
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{at}/v0/ids/generation=000003")  # what a session left that died in its fourth batch
    other = spark.newSession()
    again = H.History.open(other, at)
    assert (again.generations, again.buckets, again.places) == (3, 128, history.places)
    one = shaped(other, texts[:1])  # a small batch opens few of the buckets
    probes = H.filed(H.vectors(H.prepared(one), again.places))
    touched = again._touched(probes, "cell")
    few, whole = again.shelf("cells", touched), again.shelf("cells")
    opened = lambda df: df.select(F.input_file_name()).distinct().count()
    assert 0 < len(touched) < 30 and opened(few) < opened(whole) / 2 and few.count() < whole.count() / 2
    assert f"PartitionFilters: [bucket" in few._jdf.queryExecution().executedPlan().toString()
    got |= {(r["id_a"], r["id_b"]) for r in again.ingest(shaped(other, last)).collect()}
    assert got == brute(rows)
    n = again.shelf("texts").count()
    again.compact()
    reopened = H.History.open(spark, at)
    assert (reopened.generations, reopened.shelf("texts").count(), reopened.buckets) == (1, n, 4)
    repeat = shaped(spark, [(f"n{r[0]}", 4, 0, r[3]) for r in texts])
    old = brute(rows + [(f"n{r[0]}", 4, 0, r[3]) for r in texts]) - brute(rows)
    assert {(r["id_a"], r["id_b"]) for r in reopened.ingest(repeat).collect()} == old and old
    assert reopened.ingest(df.limit(0)).count() == 0


def test_kinds_stay_apart(spark, tmp_path):
    rnd = random.Random(5)
    text = " ".join(rnd.choice(WORDS) for _ in range(90))
    history = H.History.create(spark, f"file://{tmp_path}/k")
    for b in range(2):
        both = shaped(spark, [(f"s{b}", b, 0, text)], "submission").unionByName(shaped(spark, [(f"c{b}", b, 0, text)]))
        found = sorted(tuple(r) for r in history.ingest(both).collect())
    assert found == [("comment", "c0", "c1"), ("submission", "s0", "s1")]


def test_prefixes_and_sketches_never_lose_a_near_vector():
    rnd = random.Random(4)
    for _ in range(300):
        a = rnd.sample(range(10**6), rnd.randrange(60, 200))
        keep = rnd.sample(a, -(-len(a) * 8 // 10))
        b = keep + rnd.sample(range(10**6, 2 * 10**6), rnd.randrange(0, len(a) - len(keep) + 1))
        order = lambda v: (v * 7919 % 10007, v)
        x, y = sorted(a, key=order), sorted(b, key=order)
        assert set(x[: H.prefix_length(len(x))]) & set(y[: H.prefix_length(len(y))])
        flipped = sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(H.parities(a), H.parities(b)))
        assert flipped <= len(set(a) ^ set(b))


def test_cells_of_several_coordinates_never_lose_a_near_vector():
    rnd = random.Random(6)
    weights = [1 / (i + 3) for i in range(1500)]
    for depth in range(1, H.DEEPEST + 1):
        for _ in range(60):
            a = sorted(set(rnd.choices(range(1500), weights, k=rnd.randrange(150, 500))))[: rnd.randrange(60, 140)]
            if len(a) < 60:
                continue
            lost = len(a) - -(-len(a) * 8 // 10)
            b = sorted(set(a) - set(rnd.sample(a, lost))) + rnd.sample(range(2000, 4000), rnd.randrange(lost + 1))
            keyed = lambda v: sorted((1500 - c if c < 1500 else 0, c * 0x9E3779B97F4A7C15 & (1 << 64) - 1, min(12.0, 2 + c / 100), c % H.PARTS) for c in v)
            x, y = (dict(zip(*H.cells_of(keyed(v), depth, 9.0))) for v in (a, b))
            need = -(-max(len(a), len(b)) * 8 // 10)
            assert len(set(a) & set(b)) >= need
            assert any(1 + min(len(a) - x[c] - 1, len(b) - y[c] - 1) >= need for c in set(x) & set(y))


def test_deep_cells_against_brute_force(spark, tmp_path, monkeypatch):
    rows = records(random.Random(13))
    df, want = shaped(spark, rows), brute(rows)
    for enough, depth in ((1, 2), (1e-6, 6)):
        monkeypatch.setattr(H, "CELL_TEXTS", enough)
        monkeypatch.setattr(H, "ROUND_CELLS", 100)
        assert H.arranged(H.prepared(df.where("batch = 0 AND text IS NOT NULL")), 30).depth == depth
        got = [(r["id_a"], r["id_b"]) for r in H.repeated_records(df, Workspace(spark, "t")).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 40
        history, one = H.History.create(spark, f"file://{tmp_path}/{depth}"), set()
        for b in range(4):
            one |= {(r["id_a"], r["id_b"]) for r in history.ingest(df.where(F.col("batch") == b)).collect()}
        assert one == want and H.History.open(spark, f"file://{tmp_path}/{depth}").places == history.places


def test_texts_of_one_vocabulary_do_not_fill_the_cells(spark, tmp_path):
    rnd, n = random.Random(8), 4000
    weights = [1 / (i + 10) for i in range(1500)]
    rows = [(f"i{i}", 0, i, " ".join(f"w{k}" for k in rnd.choices(range(1500), weights, k=rnd.randrange(65, 110)))) for i in range(n)]
    history = H.History.create(spark, f"file://{tmp_path}/v")
    history.ingest(shaped(spark, rows))
    met = history.shelf("cells").groupBy("cell").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert met < 0.05 * n * (n - 1) / 2
