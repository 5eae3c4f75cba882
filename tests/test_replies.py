import json

from tidemark.operators import replies

SCHEMA = "file string, line_no bigint, line string"


def envelope(payload, status="completed", shape="body"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    out = [{"content": [{"text": text}]}]
    response = {"body": {"status": status, "output": out}} if shape == "body" else {"output_text": text} if shape == "short" else {"output": out}
    return json.dumps({"custom_id": "x", "response": response})


def parse(spark, lines, kind="rs", **kw):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], SCHEMA)
    return {r["id"]: r for r in replies.annotations(df, kind, **kw).collect()}


def item(sid="a", **kw):
    return {"submission_id": sid, "is_forward": "yes", "value_score": "0.4", "tickers": []} | kw


def test_shapes_and_statuses(spark):
    got = parse(
        spark,
        [envelope({"results": [item("a")]}), envelope([item("b")], shape="short"), envelope(item("c"), shape="bare"), envelope([item("d")], status="failed"), "{broken", "[]", "3", envelope("no json"), envelope({"other": 1}), envelope([1, "x", None, item("e", is_forward=1, value_score="x", tickers=None)]), envelope([item(5)])],
    )
    assert sorted(got) == ["5", "a", "b", "c", "e"]
    assert (got["a"]["is_forward"], got["a"]["value_score"]) == (True, 0.4)
    assert (got["e"]["is_forward"], got["e"]["value_score"], got["e"]["ticker_items"]) == (None, None, [])


def test_ticker_fields(spark):
    tickers = [
        {"symbol": " abc ", "asset_type": "Stock", "sentiment_label": "Bullish", "sentiment_score": "0.6", "conf": 0.8},
        {"ticker": "d", "label": "meh", "score": True, "confidence": "x"},
        {"symbol": "e", "sentiment_label": None, "label": "positive", "asset_type": 5, "sentiment_score": None, "score": 1},
        {"symbol": " "}, {"symbol": 3}, "text", None,
    ]
    got = [tuple(t) for t in parse(spark, [envelope([item(tickers=tickers)])])["a"]["ticker_items"]]
    assert got == [("ABC", "other", "positive", 0.6, 0.8), ("D", None, "neutral", 1.0, None), ("E", None, None, None, None)]


def test_last_wins_and_comment_items(spark):
    lines = [envelope([item(value_score=1)]), envelope([item(value_score=2), item(value_score=3, comment_id="c")])]
    assert parse(spark, lines)["a"]["value_score"] == 2
    assert parse(spark, lines, comment_items_too=True)["a"]["value_score"] == 3
    assert parse(spark, lines, kind="rc")["c"]["value_score"] == 3
    assert parse(spark, []) == {}


def test_annotate_and_explode(spark):
    docs = spark.createDataFrame([("a", "u", 1), ("b", None, None)], "id string, author string, score int")
    df = spark.createDataFrame([("f", 0, envelope([item(tickers=[{"symbol": "x"}, {"symbol": "x"}])]))], SCHEMA)
    notes = replies.annotations(df, "rs")
    both = replies.annotate(docs, notes, "rs")
    assert {r["id"]: r["tickers"] for r in both.collect()} == {"a": ["X", "X"], "b": []}
    assert [r["symbol"] for r in replies.explode_mentions(both).collect()] == ["X", "X"]
    assert replies.annotate(docs, notes, "rc").count() == 1
    assert [r["id"] for r in replies.without_reply(docs, notes).collect()] == ["b"]
    aliases = spark.createDataFrame([(" x ", "y"), ("", "z"), ("q", None)], "raw string, normalized string")
    assert {r["symbol"] for r in replies.apply_aliases(replies.explode_mentions(both), "symbol", aliases).collect()} == {"Y"}


def test_earlier_dialects(spark):
    both = {"symbol": "x", "label": "bullish", "sentiment_label": "negative", "score": 1, "sentiment_score": 2}
    line = envelope([item("a", is_forward="maybe", tickers=[both])])
    t = parse(spark, [line], version="v2")["a"]
    assert (t["ticker_items"][0]["sentiment_label"], t["ticker_items"][0]["sentiment_score"], t["is_forward"]) == ("positive", 1.0, False)
    t = parse(spark, [line], version="v3")["a"]
    assert (t["ticker_items"][0]["sentiment_label"], t["ticker_items"][0]["sentiment_score"]) == ("negative", 2.0)
    assert parse(spark, [line])["a"]["is_forward"] is None
    assert set(parse(spark, [envelope([{"id": "z", "tickers": []}])], version="v3")) == {"z"}
    full = {"symbol": "abc", "sentiment_label": "positive", "sentiment_score": "0.5", "confidence": 1}
    good, bad = item("g", tickers=[full]), item("b", tickers=[full | {"confidence": None}])
    assert set(parse(spark, [envelope({"results": [good]}), envelope({"results": [good | {"submission_id": "h"}, bad]})], version="v1")) == {"g"}
    assert parse(spark, [envelope({"results": [good]})], version="v1")["g"]["ticker_items"][0]["symbol"] == "abc"
