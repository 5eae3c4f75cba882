import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import thread_key
from tidemark.operators import hierarchy as H
from tidemark.session import Workspace


def brute(parent):
    """Of {k: p}: ancestors from the root down, None for nodes that never reach a root; and the nodes on circles."""
    above, circles = {}, set()
    for k in parent:
        chain, u = [], k
        while u in parent and u not in chain:
            chain.append(u)
            u = parent[u]
        if u in chain:
            above[k] = None
            if u == k:
                circles.add(k)
        else:
            above[k] = chain[::-1]
    return above, circles


def run(spark, rows):
    df = spark.createDataFrame(rows, "k string, p string")
    h = H.hierarchy(H.nodes(df, F.col("k"), F.col("p")), Workspace(spark, "t"))
    return {r["k"]: r for r in H.paths(h).collect()}, h


def check(spark, rows):
    parent = {}
    for k, p in rows:
        if k is not None:
            parent[k] = min([x for x in (parent.get(k), p) if x is not None], default=None)
    above, circles = brute(parent)
    got, h = run(spark, rows)
    assert set(got) == set(parent)
    below = {k: sum(1 for a in above.values() if a and k in a[:-1]) for k in parent}
    for k, chain in above.items():
        r = got[k]
        assert r["cyclic"] == (k in circles)
        if chain is None:
            assert r["root"] is None and r["depth"] is None and r["path"] is None
        else:
            assert (r["root"], r["depth"], r["path"], r["descendants"]) == (chain[0], len(chain) - 1, "/".join(chain), below[k])
            assert r["exit"] - r["entry"] == 2 * below[k] + 1
    pairs = sorted((r["ancestor"], r["k"]) for r in H.ancestor_pairs(h).collect())
    assert pairs == sorted((a, k) for k, chain in above.items() if chain for a in chain[:-1])


def test_random_forest_with_circles(spark):
    rnd = random.Random(5)
    ids = [f"n{i}" for i in range(300)]
    rows = [(k, rnd.choice([None, "gone", rnd.choice(ids[: i or 1]), rnd.choice(ids[max(0, i - 3) : i] or [None])]) if i < 270 else rnd.choice(ids[250:])) for i, k in enumerate(ids)]
    check(spark, rows + rows[:20])


@pytest.mark.parametrize("levels", [0, 2, H.BLOCK_LEVELS])
def test_chain_star_self_loop_and_long_circle(spark, monkeypatch, levels):
    monkeypatch.setattr(H, "BLOCK_LEVELS", levels)
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(130)]
    star = [(f"s{i}", "hub") for i in range(200)] + [("hub", None)]
    circle = [(f"o{i}", f"o{(i + 1) % 7}") for i in range(7)] + [(f"tail{i}", f"tail{i - 1}" if i else "o3") for i in range(20)]
    check(spark, chain + star + circle + [("self", "self"), ("leads", "self"), (None, "c1"), (None, None)])


def test_empty(spark):
    got, _ = run(spark, [])
    assert got == {}


def test_circle_ids_keep_stored_spelling_and_ignore_extra_columns(spark):
    rows = [("T1_a", " t1_B ", "x"), ("b", "A", "y"), ("b", "A", "y"), ("c", "a", "z"), (None, "a", "z"), ("d", None, "k")]
    df = spark.createDataFrame(rows, "id string, parent string, k string")
    assert sorted(r[0] for r in H.circle_ids(df, "id", thread_key("id"), thread_key("parent"), Workspace(spark, "t")).collect()) == ["T1_a", "b"]
    assert H.circle_ids(df.limit(0), "id", thread_key("id"), thread_key("parent"), Workspace(spark, "t")).count() == 0
