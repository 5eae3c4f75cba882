import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import annotate, cli, session
from tidemark.operators import clean, requests
from tidemark.sources import readers, sinks
from tidemark.sources.replies import reply_lines
from tidemark.streaming import daily as streaming

RAW = [
    '{"id":"a1","created_utc":1746057600,"subreddit":"Stocks","title":"ABC earnings","selftext":"Buying ABC","score":12,"num_comments":3,"author":"u1","over_18":false}',
    '{"id":"a2","created_utc":"1746057660","subreddit":"stocks","title":"t","selftext":null,"score":"7","num_comments":null,"author":"u1","over_18":"true"}',
    "{broken",
    '{"id":"a3","subreddit":"stocks","title":"no timestamp"}',
    '{"id":"a4","created_utc":"soon","subreddit":"stocks","score":"3.7"}',
    '{"id":"a5","created_utc":1,"subreddit":"cats"}',
    "[1]",
]


def test_zstd_lines_and_records(spark, tmp_path):
    import zstandard

    path = tmp_path / "x.zst"
    path.write_bytes(zstandard.ZstdCompressor().compress("\n".join(RAW).encode() + b"\n\xff\xfe"))
    lines = readers.zstd_lines(spark, [str(path)], lines_per_batch=3)
    assert [r["line_no"] for r in lines.orderBy("line_no").collect()] == list(range(len(RAW) + 1))
    got = {r["id"]: r for r in readers.parse_records(lines, "rs").collect()}
    assert sorted(got) == ["a1", "a2", "a4"]
    assert (got["a2"]["created_utc"], got["a2"]["score"], got["a2"]["selftext"], got["a2"]["over_18"]) == (1746057660, 7, "", True)
    assert (got["a4"]["created_utc"], got["a4"]["score"], got["a4"]["day"]) == (0, 0, dt.date(1970, 1, 1))
    assert sorted(r["id"] for r in readers.parse_records(lines, "rs", drop_nsfw=True).collect()) == ["a1", "a4"]


def test_day_sink_skips_or_replaces(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", dt.date(2025, 1, 1)), ("b", dt.date(2025, 1, 2))], "id string, day date")
    sinks.write_days(df, root)
    sinks.write_days(df, root)
    assert spark.read.parquet(root).count() == 2
    sinks.write_days(df.where("id = 'a'").union(df.where("id = 'a'")), root, force=True)
    assert spark.read.parquet(root).count() == 3
    sinks.append_new(df.withColumn("day", F.date_add("day", 1)), root, ["id", "day"])
    assert spark.read.parquet(root).count() == 5
    assert sinks.stored_days(spark, root) == {"2025-01-01", "2025-01-02", "2025-01-03"}
    days = readers.read_days(spark, root, "2025-01-02", "2025-01-02", ["id", "gone"])
    assert days.columns == ["id", "gone"] and days.count() == 2


def test_lists(spark, tmp_path):
    p = tmp_path / "ids.txt"
    p.write_text("﻿a\n\n b \na\n", encoding="utf-8")
    assert [r[0] for r in readers.read_ids(spark, str(p)).collect()] == ["a", "b"]
    p.write_text("z\na\nz\nm\n", encoding="utf-8")
    assert [r[0] for r in readers.read_ids(spark, str(p)).collect()] == ["z", "a", "m"]
    p = tmp_path / "missing.txt"
    p.write_text("['abc'], # note\n# comment\n\nx y\n", encoding="utf-8")
    assert sorted(r[0] for r in readers.read_symbols(spark, str(p)).collect()) == ["ABC", "X"]
    p = tmp_path / "alias.csv"
    p.write_text("raw,normalized\n a ,b\n,c\na,d\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_aliases(spark, str(p)).collect()] == [("A", "D")]


def test_requests_round_trip_through_the_annotator(spark, tmp_path):
    posts = spark.createDataFrame([("p1", 5, "post é"), ("p2", 1, "other"), ("p3", 2, "  ")], "id string, created_utc bigint, text string")
    comments = spark.createDataFrame([(f"c{i:02d}", i, f"T3_P1 ", f"say {i}") for i in range(16)] + [("cx", 1, None, "lost")], "id string, created_utc bigint, link_id string, text string")
    r = requests.requests(posts, comments)
    assert sorted(x["custom_id"] for x in r.collect()) == ["sub:p1:0000", "sub:p1:0001", "sub:p2:0000"]
    rows = sinks.write_request_parts(r, str(tmp_path / "req"), per_part=2)
    assert [(x["part"], x["requests"]) for x in rows] == [(0, 2), (1, 1)] and sum(x["docs"] for x in rows) == 16 + 3
    files = sorted((tmp_path / "req").glob("part-*.jsonl"))
    assert [str(f) for f in files] == [x["path"] for x in rows] and not (tmp_path / "req" / "_parts").exists()
    first = json.loads(files[0].read_text(encoding="utf-8").splitlines()[0])
    assert first["body"]["input"][1]["content"].startswith("Return JSON only") and first["custom_id"] == "sub:p2:0000"
    out = tmp_path / "results"
    assert annotate.collect(annotate.OfflineAnnotator(), files, out, in_flight=1, sleep=lambda s: None) == {f.name: "completed" for f in files}
    assert annotate.outstanding(files, out) == []
    (out / "part-00000.errors.jsonl").write_text("{}\n")
    assert reply_lines(spark, str(out)).count() == 3
    sinks.write_manifest(spark, rows, str(tmp_path / "manifest.json"), kind="rs", start=None)
    kept = json.loads((tmp_path / "manifest.json").read_text())
    assert (kept["requests"], kept["docs"], kept["kind"], kept["start"]) == (3, 19, "rs", None)


def test_numbering_without_a_single_task(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = {r["x"]: r["pos"] for r in requests.numbered_globally(df, ["x"], 10).collect()}
    assert got == {i: i for i in range(1000)}


def test_numbering_within_groups_of_any_size(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x")).select("x", F.when(F.col("x") % 7 == 0, None).when(F.col("x") < 400, "hot").otherwise("b").alias("g"))
    rows = requests.numbered_within(df, ["g"], ["x"], 16).collect()
    for g in ("hot", "b", None):
        mine = sorted((r["x"], r["pos"], r["chunk"]) for r in rows if r["g"] == g)
        assert [(p, c) for _, p, c in mine] == [(i, i // 16) for i in range(len(mine))]


def test_earlier_request_forms(spark):
    docs = spark.createDataFrame([(dt.date(2025, 1, 1), f"d{i:02d}", i, " text " if i else "", "t3_p", None) for i in range(18)], "day date, id string, created_utc bigint, text string, link_id string, context string")
    forms = {v: requests.grouped_requests(docs, "rc", v).orderBy("chunk").collect() for v in ("v1", "v2", "v3")}
    assert {v: [r["docs"] for r in rs] for v, rs in forms.items()} == {"v1": [16, 2], "v2": [16, 1], "v3": [16, 1]}
    assert [r["custom_id"] for r in forms["v1"]] == ["2025-01-01_d00", "2025-01-01_d16"] and forms["v2"][1]["custom_id"] == "rc:2025-01-01:d17:0001"
    content = lambda r: json.loads(r["line"])["body"]["input"][1]["content"].split("\n", 2)
    assert json.loads(content(forms["v3"][1])[2]) == {"kind": "comment", "comment_id": "d17", "submission_id": "p", "comment_text": "text", "submission_text": ""}
    assert json.loads(content(forms["v2"][1])[2])["user"] == "id=d17\nallow_etf=false\ntext:\n text "
    assert requests.grouped_requests(docs.limit(0), "rc", "v3").count() == 0


def test_prices_are_retried_one_by_one():
    class Source:
        def __init__(self):
            self.calls = []

        def bars(self, symbols, start, end):
            self.calls.append(tuple(symbols))
            if len(self.calls) == 1:
                raise OSError("busy")
            return [{"symbol": s} for s in symbols if s != "Z" and (len(symbols) == 1 or s != "B")]

    source = Source()
    rows, missing = annotate.fetch_bars(source, ["A", "B", "Z"], "a", "b", sleep=lambda s: None)
    assert sorted(r["symbol"] for r in rows) == ["A", "B"] and missing == ["Z"]


def test_streaming_runs_what_is_available(spark, tmp_path):
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    rows = [("1", 86400 * 10, "A", 1, 0.5), ("2", 86400 * 10 + 5, " a ", 2, None), ("3", 86400 * 20, "A", 1, 0.1), ("4", None, "A", 1, 0.1)]
    schema = "id string, created_utc bigint, symbol string, score int, sentiment_score double"
    spark.createDataFrame(rows, schema).write.parquet(src)
    for _ in range(2):
        streaming.run_available(streaming.daily_counts(streaming.arriving(spark, src, schema)), out, state).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert [(r["symbol"], r["chatter_count"], r["score_sum"], r["sent_mean"]) for r in got] == [("A", 2, 3.0, 0.5)]


def test_streaming_counts_late_rows(spark, tmp_path):
    src, places = str(tmp_path / "in"), [str(tmp_path / p) for p in ("store", "out", "cp")]
    schema = "id string, created_utc bigint, symbol string, score int, sentiment_score double"
    day = lambda n: 86400 * n
    arrivals = [
        [("1", day(10), "A", 1, 0.5), ("2", day(10) + 5, " a ", 2, None), ("3", day(20), "A", 1, 0.1), ("4", None, "A", 1, 0.1)],
        [("5", None, "A", 1, 0.1)],
        [("6", day(10) + 9, "A", 4, 0.7), ("7", day(1), "B", None, None)],
        [],
    ]
    for rows in arrivals:
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        streaming.run_daily_counts(streaming.arriving(spark, src, schema), *places).awaitTermination()
    got = {(str(r["day"]), r["symbol"]): (r["chatter_count"], r["score_sum"], r["sent_mean"]) for r in spark.read.parquet(places[1]).collect()}
    assert got == {("1970-01-02", "B"): (1, 0.0, None), ("1970-01-11", "A"): (3, 7.0, 0.6), ("1970-01-21", "A"): (1, 1.0, 0.1)}


def test_streaming_keeps_late_first_deliveries(spark, tmp_path):
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "id string, created_utc bigint"
    for rows in [[("1", 86400 * 50), ("1", 86400 * 50), (None, 5)], [("1", 86400 * 90), ("2", 86400), (None, 6)], [("2", 86400 * 2), ("3", 1)]]:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        streaming.run_first_deliveries(streaming.arriving(spark, src, schema), "id", out, state).awaitTermination()
    got = sorted((r["id"] or "", r["created_utc"]) for r in spark.read.parquet(out).collect())
    assert got == [("", 5), ("1", 86400 * 50), ("2", 86400), ("3", 1)]


def test_settings_order(tmp_path):
    try:
        import yaml  # noqa: F401
    except ImportError:
        a = cli.settings(["clean", "--input", "x", "--window-seconds", "5"])
        assert (a.window_seconds, a.force) == (5, False)
        return
    p = tmp_path / "c.yaml"
    p.write_text("window-seconds: 7\nkind: rs\ndrop_nsfw: true\n")
    a = cli.settings(["clean", "--config", str(p), "--kind", "rc"])
    assert (a.window_seconds, a.kind, a.drop_nsfw, a.scope) == (7, "rc", True, "history")


def test_default_communities(spark):
    raw = [json.dumps({"id": s, "created_utc": 1, "subreddit": s}) for s in ("PennyStocks", "options", "stocks")]
    lines = spark.createDataFrame([(r,) for r in raw], "line string")
    assert sorted(r["id"] for r in readers.parse_records(lines, "rs").collect()) == ["PennyStocks", "stocks"]


def test_ended_batches_keep_what_they_have(tmp_path):
    class Client:
        def submit(self, path):
            return path.name

        def status(self, batch):
            return "expired" if batch != "part-00002.jsonl" else "cancelled"

        def output(self, batch):
            return ["{}"] if batch == "part-00000.jsonl" else []

    files = [tmp_path / f"part-0000{i}.jsonl" for i in range(3)]
    for f in files:
        f.write_text("{}")
    out = tmp_path / "out"
    assert set(annotate.collect(Client(), files, out, sleep=lambda s: None).values()) == {"expired", "cancelled"}
    assert sorted(p.name for p in out.iterdir()) == ["part-00000.jsonl", "part-00001.errors.jsonl", "part-00002.errors.jsonl"]


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(ValueError):
        session.shared_dir(Session())
    assert session.shared_dir(spark)


class Prices:
    """Bars of every day but for the symbol GONE; ends are exclusive."""

    def bars(self, symbols, start, end):
        assert end == "2025-05-04"
        return [{"symbol": s.lower(), "day": dt.date(2025, 5, d), "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": float(d), "Adj Close": float(d), "Volume": 10} for s in symbols if s != "GONE" for d in (1, 2, 3, 4)]


class Annotator(annotate.OfflineAnnotator):
    """Names two tickers for each item."""

    def output(self, batch):
        return [x.replace('\\"tickers\\": []', '\\"tickers\\": [' + ", ".join('{\\"symbol\\": \\"%s\\", \\"label\\": \\"positive\\", \\"score\\": 0.5, \\"conf\\": 0.9}' % s for s in ("abc", "gone")) + "]") for x in super().output(batch)]


def test_every_cli_stage_runs_end_to_end(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda master: spark)
    at = lambda name: str(tmp_path / name)
    posts = [{"id": f"p{i}", "created_utc": 1746057600 + 86400 * (i % 3) + i, "subreddit": "Stocks", "title": f"ABC number {i}", "selftext": f"Buying ABC for reason {i}", "score": i, "num_comments": 3, "author": f"u{i}", "over_18": False} for i in range(6)]
    comments = [{"id": f"c{i}", "created_utc": 1746057700 + 86400 * (i % 3) + i, "subreddit": "stocks", "body": f"I like it, reason number {i}", "score": 1, "author": f"v{i}", "parent_id": "t3_p0", "link_id": "t3_p0"} for i in range(4)]
    for name, rows in (("rs.jsonl", posts), ("rc.jsonl", comments)):
        (tmp_path / name).write_text("\n".join(map(json.dumps, rows)) + "\n{broken\n", encoding="utf-8")
    (tmp_path / "prompt.txt").write_text("Say what you see.\nOnly JSON.", encoding="utf-8")
    for kind in ("rs", "rc"):
        cli.main(["ingest", "--kind", kind, "--input", at(f"{kind}.jsonl"), "--output", at(f"raw-{kind}"), "--log", at("logs/run.log")])
        cli.main(["clean", "--kind", kind, "--input", at(f"raw-{kind}"), "--output", at(f"clean-{kind}")])
    log = (tmp_path / "logs" / "run.log").read_text()
    assert "DONE (rs) rs.jsonl" in log and "lines=7 kept=6" in log and "lines=5 kept=4" in log
    cli.main(["prepare", "--input", at("clean-rs"), "--comments", at("clean-rc"), "--output", at("requests"), "--prompt", at("prompt.txt"), "--per-part", "4", "--max-days", "2"])
    manifest = json.loads((tmp_path / "requests" / "manifest.json").read_text())
    assert manifest["requests"] == 4 and [p["requests"] for p in manifest["parts"]] == [4]
    assert json.loads((tmp_path / "requests" / "part-00000.jsonl").read_text().splitlines()[0])["body"]["input"][0]["content"] == "Say what you see.\nOnly JSON."
    cli.main(["submit", "--input", at("requests"), "--output", at("replies"), "--client", f"{__name__}:Annotator", "--pause", "0"])
    cli.main(["parse", "--kind", "rs", "--input", at("clean-rs"), "--replies", at("replies"), "--output", at("annotated")])
    assert "DONE (parse rs) docs=6 with_tickers=4" in capsys.readouterr().out
    assert sorted(r["id"] for r in spark.read.json(at("annotated-failed")).collect()) == ["p2", "p5"]
    (tmp_path / "alias.csv").write_text("raw,normalized\nabc,ABCD\n")
    cli.main(["explode", "--input", at("annotated"), "--output", at("mentions"), "--aliases", at("alias.csv")])
    mentions = readers.read_days(spark, at("mentions"))
    moved = mentions.where("id = 'p0' AND symbol = 'ABCD'").withColumn("created_utc", F.col("created_utc") + 3 * 86400)
    sinks.write_days(mentions.unionByName(moved.withColumn("id", F.lit("px"))), at("mixed"))  # a row of another day at this place
    cli.main(["daily", "--input", at("mixed"), "--output", at("daily")])
    rows = {(r["symbol"], str(r["day"])): r["chatter_count"] for r in spark.read.parquet(at("daily")).collect()}
    assert rows == {(s, f"2025-05-0{d}"): 2 for s in ("ABCD", "GONE") for d in (1, 2)}
    window = ["--start", "2025-05-01", "--end", "2025-05-03", "--client", f"{__name__}:Prices", "--pause", "0"]
    cli.main(["fetch-prices", "--input", at("daily"), "--output", at("prices"), *window])
    assert spark.read.parquet(at("prices")).count() == 3 and [r[0] for r in spark.read.text(at("prices-missing")).collect()] == ["GONE"]
    (tmp_path / "again.csv").write_text("raw,normalized\nGONE,OTHER\n")
    for _ in range(2):
        cli.main(["refetch", "--seeds", at("prices-missing"), "--aliases", at("again.csv"), "--output", at("prices"), *window])
    assert sorted({r["symbol"] for r in spark.read.parquet(at("prices")).collect()}) == ["ABCD", "GONE"] and spark.read.parquet(at("prices")).count() == 6
    cli.main(["merge", "--input", at("daily"), "--prices", at("prices"), "--output", at("merged")])
    cli.main(["enrich", "--input", at("merged"), "--output", at("features"), "--start", "2025-05-02"])
    done = spark.read.parquet(at("features")).collect()
    assert sorted(r["symbol"] for r in done) == ["ABCD", "GONE"] and {r["Close"] for r in done} == {2.0}
    cli.main(["prepare", "--form", "v3", "--kind", "rc", "--input", at("clean-rc"), "--posts", at("clean-rs"), "--output", at("grouped"), "--per-request", "2"])
    assert json.loads((tmp_path / "grouped" / "manifest.json").read_text())["docs"] == 4
