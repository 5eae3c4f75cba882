import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import market

D = lambda n: dt.date(2025, 1, 1) + dt.timedelta(n)
BAR = 'symbol string, day date, Open double, High double, Low double, Close double, "Adj Close" double, Volume bigint'.replace('"Adj Close"', "`Adj Close`")


def bars(spark, closes, symbol="A"):
    return spark.createDataFrame([(symbol, D(i), c, c, c, c, c, 10) for i, c in enumerate(closes)], BAR)


def test_returns_fill_gaps_and_zero_divisors(spark):
    out = [r["ret1"] for r in market.with_returns(bars(spark, [10.0, None, 20.0, 0.0, 5.0])).orderBy("day").collect()]
    assert out == [None, 0.0, 1.0, -1.0, None]
    assert [r["ret1"] for r in market.with_returns(bars(spark, [10.0, None, 20.0]), fill=False).orderBy("day").collect()] == [None, None, None]


def test_unique_bars_and_validation(spark):
    twice = bars(spark, [1.0, 2.0]).union(bars(spark, [3.0, None])).withColumn("symbol", F.lit(" a "))
    one = market.unique_bars(twice)
    assert sorted((r["day"].day, r["Close"]) for r in one.collect()) == [(1, 3.0), (2, 2.0)]
    daily = spark.createDataFrame([("a", D(0), 1)], "symbol string, day date, chatter_count bigint")
    assert market.merge_features(daily, one).count() == 1
    with pytest.raises(Exception, match="not unique"):
        market.merge_features(daily, twice.withColumn("symbol", F.lit("A"))).collect()


def test_targets_and_scopes(spark):
    merged = market.with_returns(bars(spark, [10.0, 20.0, 40.0]))
    for c in {*market.LAGGED, *market.SUMMED, *market.AVERAGED}:
        merged = merged.withColumn(c, F.lit(1.0))
    rows = market.enrich(merged).orderBy("day").collect()
    assert [r["ret1_lead1"] for r in rows] == [-0.5, -0.5, None] and [r["fwd_ret1"] for r in rows] == [1.0, 1.0, None]
    assert [r["sent_mean_roll3_sum"] if "sent_mean_roll3_sum" in r else r["chatter_count_roll3_sum"] for r in rows] == [1.0, 2.0, 3.0]
    alone = market.enrich(merged, scope="partition").orderBy("day").collect()
    assert [r["chatter_count_lag1"] for r in alone] == [None] * 3 and [r["chatter_count_roll3_sum"] for r in alone] == [1.0] * 3
    assert len(market.enrich(merged).columns) == len(merged.columns) + 97 + 3


def test_windows_share_one_exchange(spark):
    merged = market.with_returns(bars(spark, [10.0, 20.0, 40.0]))
    for c in {*market.LAGGED, *market.SUMMED, *market.AVERAGED}:
        merged = merged.withColumn(c, F.lit(1.0))
    plan = market.enrich(merged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_wide_to_long_and_ticks(spark):
    wide = spark.createDataFrame([(D(0), 1.0, None, None), (D(1), None, None, 2.0)], "day date, `A|Close` double, `A|Volume` double, `B|Close` double").withColumn("B|Volume", F.lit(None).cast("double"))
    assert sorted((r["symbol"], r["day"].day) for r in market.wide_to_long(wide, "day", ["A", "B"], ["Close", "Volume"]).collect()) == [("A", 1), ("B", 2)]
    ticks = spark.createDataFrame([("A", dt.datetime(2025, 1, 1, 9), 1, 5.0), ("A", dt.datetime(2025, 1, 1, 9), 0, 4.0), ("A", dt.datetime(2025, 1, 1, 10), 2, None)], "s string, t timestamp, i int, p double")
    r = market.bars_from_ticks(ticks, "s", "t", "p", "i").first()
    assert (r["Open"], r["Close"], r["Volume"]) == (4.0, 5.0, 2)


def test_merge_knows_symbols_in_any_form(spark):
    daily_ = spark.createDataFrame([(dt.date(2025, 1, 1), " abc", 1)], "day date, symbol string, n int")
    bars = spark.createDataFrame([(dt.date(2025, 1, 1), "Abc ", 2.0)], "day date, symbol string, Close double")
    assert [tuple(r) for r in market.merge_features(daily_, bars).select("symbol", "n", "Close").collect()] == [("ABC", 1, 2.0)]
