import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.llm import canonical, nearest

LIST = [("ABXQF", "Talnixis Mobility Co"), ("MA", "Ilrilane Textiles Group"), ("QXM.B", "Quamadarix Robotics SE"), ("UXRF-USD", "Ullinibrix Semiconductors Co"), ("ZZKWT", "Velmomivik Retail plc"), ("PLVV", "Pelvolalane Foods Holdings")]
CASES = {
    "abxqf": "ABXQF", " ABXQF ": "ABXQF", "$ABXQF": "ABXQF", "(ABXQF)": "ABXQF", "A B X Q F": "ABXQF", "ＡＢＸＱＦ": "ABXQF", "MERI:ABXQF": "ABXQF", "ABXF": "ABXQF", "ABXQQF": "ABXQF", "ABYQF": "ABXQF", "ABXFQ": "",
    "Talnixis": "ABXQF", "the Talnixis shares": "ABXQF", "TALNIXIS MOBILITY CO": "ABXQF", "Talnixis, Mobility, Co": "ABXQF", "TalnixisMobility": "ABXQF", "talnixs mobility": "ABXQF", "Talnnixs": "",
    "ma": "MA", "mA shares": "MA", "mb": "", "PLV": "", "plvv": "PLVV", "PLVW": "", "qxm/b": "QXM.B", "UXRF/USD": "UXRF-USD", "uxrf-usd stock": "UXRF-USD", "all of them": "", "?": "", "n/a": "", "Co": "", "Velmomivik / $ZZKWT": "ZZKWT",
}


def test_typed_values(spark):
    ref = spark.createDataFrame([*LIST, (None, "x"), ("NONAM", None)], "symbol string, name string")
    rows = [(i, v) for i, v in enumerate([*CASES, "ABXQF", None, "", "  ", "x " * 3000 + "talnixis"])] * 2
    df = spark.createDataFrame(rows, "value int, typed string").withColumn("symbol_ref", F.lit("old"))
    out = canonical.map_column(df, "typed", ref, "symbol", "name").collect()
    assert len(out) == len(rows)
    got = {r["typed"]: r["symbol_ref"] for r in out}
    assert {v: got[v] for v in CASES} == CASES
    assert got["ABXQF"] == "ABXQF" and got["x " * 3000 + "talnixis"] == "ABXQF"
    assert got[None] is None and got[""] is None and got["  "] is None


def named(spark, entries, cases):
    """What each value of the cases is mapped to."""
    ref, df = spark.createDataFrame(entries, "symbol string, name string"), spark.createDataFrame([(v,) for v in cases], "typed string")
    return {r["typed"]: r["symbol_ref"] for r in canonical.map_column(df, "typed", ref, "symbol", "name").collect()}


def test_entries_listed_under_context_words(spark):
    cases = {
        "UK shares": "UK", "UK Equity": "UK", "MERI:UK": "UK", "UK:nord": "UK", "UK.US": "UK", "UK@EAST": "UK", "U K": "UK", "the u k stock": "UK", "the UK shares": "UK", "uk": "UK",
        "MA UK": "MA", "talnixs UK": "ABXQF", "Talnixis Mobility UK": "ABXQF", "US shares": "", "the ordinary share": "", "US": "",
        "se shares": "SE", "Quamadarix SE": "QXM.B", "the stock": "", "all of the shares": "ALLS", "ALL": "ALLS",
    }
    assert named(spark, [*LIST, ("UK", "Bavazen Airways Group"), ("SE", "Zorvalix Steel"), ("ALLS", "All Lumber Inc"), ("STOCX", "Mirfirand Water")], cases) == cases


def test_names_and_runs_of_many_words(spark):
    entries = [*LIST, ("NRTA", "Northern Lakes Water Steel Power Group"), ("NRTB", "Northern Lakes Water Steel Mining Group"), ("ORD", "Orderbookers Retail")]
    cases = {
        "the Northern Lakes Water Steel Mining Group not Orderbookers": "NRTB", "not Orderbookers: Northern Lakes Water Steel Power, long": "NRTA", "Ta l ni x is shares": "ABXQF", "Northern or Orderbookers": "ORD",
    }
    assert named(spark, entries, cases) == cases


def test_misspelt_short_first_words(spark):
    cases = {
        "Zorf": "PLVV", "zor foods": "PLVV", "the Zorrv shares": "PLVV", "Zrov": "", "Oek": "MXQ", "Oa": "MXQ", "oaks": "MXQ", "Ok steel": "MXQ", "Eak": "MXQ", "Kao": "",
        "Ap": "RRST", "Bq": "RRST", "Abq": "RRST", "Pa": "", "PLVW": "", "PLV": "", "MXZ": "", "MX": "", "RRS": "",
    }
    assert named(spark, [("PLVV", "Zorv Foods Holdings"), ("MXQ", "Oak Steel"), ("RRST", "Aq Water Ltd")], cases) == cases
    cases = {"Y": "TBQR", "XY lumber": "TBQR", "x": "TBQR", "TBQ": "", "zz": ""}
    assert named(spark, [("TBQR", "X Lumber")], cases) == cases


def test_empty_tables(spark):
    ref, df = spark.createDataFrame(LIST, "symbol string, name string"), spark.createDataFrame([("x",)], "typed string")
    assert canonical.map_column(df.limit(0), "typed", ref, "symbol", "name").count() == 0
    assert canonical.map_column(df, "typed", ref.limit(0), "symbol", "name").first()["symbol_ref"] == ""


def brute(lefts, rights, tolerance):
    out = []
    for e, t in lefts:
        near = sorted((abs(r - t), r) for x, r in rights if x == e and t is not None and r is not None and abs(r - t) <= tolerance) if e is not None else []
        out.append((e, t, near[0][1] if near else None))
    return sorted(out, key=repr)


def test_nearest_against_brute_force(spark):
    rnd = random.Random(1)
    for tolerance in (0, 1, 3, 10):
        lefts = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(-50, 200)])) for _ in range(300)]
        rights = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(-60, 210, 3)])) for _ in range(60)]
        l = spark.createDataFrame(lefts, "entity string, t int").withColumn("lo", F.lit(1)).withColumn("nearest", F.lit(9))
        r = spark.createDataFrame(rights, "e string, t int").withColumn("entity", F.lit("clash"))
        out = nearest.nearest(l, r, "entity", F.col("t"), F.col("e"), F.col("t"), tolerance)
        assert sorted(((x["entity"], x["t"], x["nearest"]) for x in out.collect()), key=repr) == brute(lefts, rights, tolerance)


def test_nearest_with_empty_sides(spark):
    df = spark.createDataFrame([("a", 1)], "entity string, t int")
    assert nearest.nearest(df, df.limit(0), "entity", F.col("t"), F.col("entity"), F.col("t"), 3).first()["nearest"] is None
    assert nearest.nearest(df.limit(0), df, "entity", F.col("t"), F.col("entity"), F.col("t"), 3).count() == 0
