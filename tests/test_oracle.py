"""Every core query against its SQL on the smallest tables."""

import datetime as dt
import glob
import os

import pytest

from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, float):
            return round(x, 6) + 0.0
        return x.date() if isinstance(x, dt.datetime) and x.time() == dt.time() else x

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLE[name])
    columns, rows = [c[0] for c in want.description], want.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(columns, rows)
