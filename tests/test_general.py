import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import references as R
from tidemark.operators import rolling

D = lambda n: dt.date(2025, 1, n)


def test_rolling_counts_identical_rows_once_and_quiet_days(spark):
    rows = [("A", D(1), 3, 1.5, "x"), ("A", D(1), 3, 1.5, "x"), ("A", D(1), 4, None, "x"), ("A", D(9), 10, 2.0, "x"), ("B", D(2), None, None, "x"), (None, D(2), 5, 1.0, "x"), ("C", None, 5, 1.0, "x")]
    df = spark.createDataFrame(rows, "s string, d date, n bigint, e double, entity string")
    out = {(r["s"], r["d"].day): r for r in rolling.trailing(df, "s", "d", ["n", "e"], [7, 30]).collect()}
    assert sorted(out) == [("A", i) for i in range(1, 10)] + [("B", 2)]
    assert (out["A", 1]["n"], out["A", 1]["e"], out["A", 1]["active"]) == (7, 1.5, True)
    assert (out["A", 5]["n"], out["A", 5]["active"], out["A", 5]["n_sum_7"], out["A", 5]["n_avg_7"]) == (0, False, 7, 7 / 5)
    assert (out["A", 9]["n_sum_7"], out["A", 9]["n_sum_30"], out["A", 9]["n_avg_30"]) == (10, 17, 17 / 9)
    assert (out["B", 2]["n"], out["B", 2]["n_sum_7"]) == (0, 0)
    assert rolling.trailing(df.limit(0), "s", "d", ["n"], [7]).count() == 0


def test_orphans_by_batch_and_report(spark):
    refs = spark.createDataFrame([("a", "m1", 0), ("a", "m1", 2), ("b", "m1", 1), ("b", "m1", 1), ("c", "m2", 1), (None, "m2", 1), ("d", None, 1)], "ref string, month string, batch int")
    parents = spark.createDataFrame([("a", 1), ("b", 0), ("d", 0)], "key string, first int")
    r = R.distinct_references(refs, F.col("ref"), F.col("month"), F.col("batch"))
    lost = R.orphans(r, parents, F.col("p.first") <= F.col("r.since"))
    assert sorted((x["key"], x["since"]) for x in lost.collect()) == [("a", 0), ("c", 1)]
    report = {x["period"]: x.asDict() for x in R.orphan_report(r, lost, "t").collect()}
    assert (report["m1"]["refs"], report["m1"]["keys"], report["m1"]["orphan_refs"], report["m1"]["orphan_keys"]) == (4, 2, 1, 1)
    assert (report["m2"]["orphan_keys"], report[None]["orphan_keys"]) == (1, 0)
    assert R.orphans(r, parents.limit(0)).count() == r.count()
    assert R.orphan_report(r.limit(0), lost.limit(0), "t").count() == 0


@pytest.mark.parametrize("name", ["p1_found", "p3_rolling", "p4_found"])
def test_problem_queries_are_registered_with_sql(name):
    import __spark_entry__ as e

    assert name in e.queries() and name in e.oracle_sql()
