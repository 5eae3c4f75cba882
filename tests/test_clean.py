import random

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import clean


def greedy(times, window):
    kept = []
    for t in sorted(times):
        if not kept or t - kept[-1] > window:
            kept.append(t)
    return kept


def test_greedy_windows_match_a_loop(spark):
    rnd = random.Random(3)
    groups = {f"g{i}": [rnd.randrange(2000) for _ in range(rnd.randrange(1, 60))] for i in range(25)} | {"chain": [0, 80, 160], "edge": [0, 100, 201]}
    rows = [(g, "d", t, f"{g}-{i:03d}") for g, ts in groups.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows + [("null", "d", None, "n1"), ("null", "d", 50, "n2")], "g string, day string, t bigint, id string")
    got = {}
    for r in clean.drop_near_duplicates(df, [F.col("g")], "day", "t", "id", 100).collect():
        got.setdefault(r["g"], []).append(r["t"])
    assert {g: sorted(ts) for g, ts in got.items() if g != "null"} == {g: greedy(ts, 100) for g, ts in groups.items()}
    assert got["null"] == [None]


def flags(spark, title, body):
    df = spark.createDataFrame([(title, body)], "t string, b string")
    r = df.select(*(c.alias(n) for n, c in text.spam_flags(F.col("t"), F.col("b")).items())).first().asDict()
    return {k for k, v in r.items() if v}


def test_spam_flags(spark):
    assert flags(spark, "", "  \n ") == {"is_empty_text"}
    assert flags(spark, None, None) == {"is_empty_text"}
    assert "has_repeat" in flags(spark, "wowwwww", "") and "has_repeat" not in flags(spark, "wowwww", "")
    assert flags(spark, "ALL CAPS TITLE", "fine text") == {"title_all_caps"}
    assert flags(spark, "SHORT", "fine text") == set() and flags(spark, "12345678", "fine text") == set()
    assert "body_mostly_urls" in flags(spark, "t", "https://example.org/abcdef x") and "body_mostly_urls" not in flags(spark, "t", "http://")
    assert "body_mostly_urls" not in flags(spark, "t", "https://abcdef plain words here")
    assert "too_many_symbols" in flags(spark, "", "a - b - c - " * 5) and "too_many_symbols" not in flags(spark, "", "a - b - c - ")


def test_clean_comments_and_empty_input(spark):
    rows = [("1", 10, "hello there", "u"), ("1", 5, "hello there", "u"), ("2", 20, "hello there", "u"), ("3", 30, " [Removed] ", "u"), ("4", 40, None, None), ("5", 50, "hello there", None), ("6", 9999, "hello there", "u")]
    df = spark.createDataFrame(rows, "id string, created_utc bigint, body string, author string")
    assert sorted(r["id"] for r in clean.clean_comments(df).collect()) == ["1", "5", "6"]
    assert clean.clean_comments(df.limit(0)).count() == 0
    posts = spark.createDataFrame([("1", 0, "a title", None, None, None), ("2", 0, None, None, "u", False), ("3", 0, "other", "x" * 100_000 + " y", "u", True)], "id string, created_utc bigint, title string, selftext string, author string, over_18 boolean")
    assert [r["id"] for r in clean.clean_submissions(posts).collect()] == ["1"]
