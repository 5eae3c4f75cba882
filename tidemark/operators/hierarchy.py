"""Parent-child rows to full hierarchies.

1. *Peeling.* Leaves are peeled off in layers until only circles are left. Round ``k`` of the peeling removes
   ``2**k`` layers at once: the pointer table holds, for each node, the ancestor ``2**k`` steps up, so its
   image is what survives that many layers. Nodes whose pointer runs past a root drop out on the way.
2. *Euler tours.* Every tree becomes a linked list that enters and leaves each inner node; a leaf is one
   element of length two. Siblings are chained in blocks, so no task sees all children of a hot parent.
3. *List ranking.* Elements jump to the next ruler (one element in ``RULER_EVERY``), the much shorter list of
   rulers is ranked by pointer doubling, and both distances are added.
4. The ranks are entry and exit positions: depth, root, number of descendants, ancestors and paths follow.

Each round is written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.session import Workspace

RULER_EVERY = 32
SIBLING_BLOCKS = 4096
#: Intervals are cut into blocks of at most two to this power: so many nodes meet under one key, however large a tree is.
BLOCK_LEVELS = 12


def nodes(df: DataFrame, key: Column, parent: Column) -> DataFrame:
    """(k, p): one row per distinct non-null key. Of several parents of a key the smallest counts; null is none."""
    return df.select(key.alias("k"), parent.alias("p")).where("k IS NOT NULL").groupBy("k").agg(F.min("p").alias("p"))


def edges(tree: DataFrame) -> DataFrame:
    """(v, to): the nodes whose parent is itself a node."""
    return tree.where("p IS NOT NULL").select(F.col("k").alias("v"), F.col("p").alias("to")).join(tree.select(F.col("k").alias("to")), "to", "left_semi").select("v", "to")


def jump(table: DataFrame) -> DataFrame:
    """Twice the steps of ``table``; nodes that run past a root drop out."""
    return table.alias("a").join(table.alias("b"), F.col("a.to") == F.col("b.v")).select(F.col("a.v").alias("v"), F.col("b.to").alias("to"))


def peel(links: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Of (v, to): the nodes on circles (k), and all that lie on or lead into circles (k)."""
    now, n = ws.save(links, "jump")
    while n:
        further, m = ws.save(jump(now), "jump")
        if m == n:  # every pointer that is left stays among those left: none ever reaches a root
            ws.drop(further)
            break
        ws.drop(now)
        now, n = further, m
    held, caught = now, now.select(F.col("v").alias("k"))
    core, size = ws.save(now.select(F.col("to").alias("k")).distinct(), "core")
    while n and size < n:  # tails that lead into circles are still to be peeled
        further, _ = ws.save(jump(now), "tail")
        smaller, m = ws.save(further.select(F.col("to").alias("k")).distinct(), "core")
        if m == size:
            ws.drop(further, smaller)
            break
        if now is not held:
            ws.drop(now)
        ws.drop(core)
        now, core, size = further, smaller, m
    return core, caught


def next_siblings(children: DataFrame) -> DataFrame:
    """Of (k, p): (k, sib), the next child of the same parent in the order of (block, key); null for the last.

    Blocks are hashes of the key, so that a parent with a third of all rows is spread over many tasks; what is
    ordered per parent is one row per block, at most SIBLING_BLOCKS.
    """
    blocks = children.withColumn("blk", F.pmod(F.xxhash64("k"), F.lit(SIBLING_BLOCKS)))
    w = W.partitionBy("p", "blk").orderBy("k")
    inside = blocks.select("p", "blk", "k", F.lead("k").over(w).alias("sib"), F.first("k").over(w).alias("head"))
    across = inside.where("sib IS NULL").select("k", F.lead("head").over(W.partitionBy("p").orderBy("blk")).alias("sib"))
    return inside.where("sib IS NOT NULL").select("k", "sib").unionByName(across)


def tour(tree: DataFrame) -> DataFrame:
    """Of acyclic (k, p), p null at roots: the linked list (el, nxt, len, up) of each tree's Euler tour."""
    children = tree.where("p IS NOT NULL").select("k", "p")
    first = children.groupBy(F.col("p").alias("k")).agg(F.min(F.struct(F.pmod(F.xxhash64("k"), F.lit(SIBLING_BLOCKS)).alias("blk"), "k")).alias("f")).select("k", F.col("f.k").alias("first"))
    full = tree.join(next_siblings(children), "k", "left").join(first, "k", "left")
    leave = F.coalesce(F.concat(F.lit("<"), "sib"), F.concat(F.lit(">"), "p"))
    inner = F.col("first").isNotNull()
    return full.select(
        F.explode(
            F.when(
                inner,
                F.array(
                    F.struct(F.concat(F.lit("<"), "k").alias("el"), F.concat(F.lit("<"), "first").alias("nxt"), F.lit(1).cast("long").alias("len"), F.lit(1).cast("long").alias("up")),
                    F.struct(F.concat(F.lit(">"), "k").alias("el"), leave.alias("nxt"), F.lit(1).cast("long").alias("len"), F.lit(-1).cast("long").alias("up")),
                ),
            ).otherwise(F.array(F.struct(F.concat(F.lit("<"), "k").alias("el"), leave.alias("nxt"), F.lit(2).cast("long").alias("len"), F.lit(0).cast("long").alias("up"))))
        ).alias("e")
    ).select("e.*")


def is_ruler(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(RULER_EVERY)) == 0


def chase(lists: DataFrame, ws: Workspace, stop: Column) -> DataFrame:
    """Pointer doubling of (el, nxt, len, up, last) until each nxt is null or meets ``stop`` (a condition on nxt)."""
    now, _ = ws.save(lists, "list")
    while True:
        open_ = F.col("nxt").isNotNull() & ~stop
        a, b = now.where(open_).alias("a"), now.alias("b")
        moved = a.join(b, F.col("a.nxt") == F.col("b.el")).select("a.el", "b.nxt", (F.col("a.len") + F.col("b.len")).alias("len"), (F.col("a.up") + F.col("b.up")).alias("up"), "b.last")
        if now.where(open_).isEmpty():
            return now
        further, _ = ws.save(now.where(~open_).unionByName(moved), "list")
        ws.drop(now)
        now = further


def rank(lists: DataFrame, ws: Workspace) -> DataFrame:
    """Of linked lists (el, nxt, len, up): (el, len, up, last), the sums from each element to its list's end."""
    start = lists.withColumn("last", F.when(F.col("nxt").isNull(), F.col("el")))
    near = chase(start, ws, is_ruler("nxt"))
    rulers = chase(near.where(is_ruler("el")), ws, F.lit(False))
    far = rulers.select(F.col("el").alias("nxt"), F.col("len").alias("len2"), F.col("up").alias("up2"), F.col("last").alias("last2"))
    done = near.join(far, "nxt", "left").select("el", (F.col("len") + F.coalesce("len2", F.lit(0))).alias("len"), (F.col("up") + F.coalesce("up2", F.lit(0))).alias("up"), F.coalesce("last", "last2").alias("last"))
    return ws.save(done, "ranks")[0]


def hierarchy(tree: DataFrame, ws: Workspace) -> DataFrame:
    """(k, p, root, depth, entry, exit, descendants, cyclic) of each node of (k, p).

    A node whose parent is null or no node is a root (depth 0). Nodes on circles have cyclic true, nodes that only
    lead into one have it false, and neither has a root, depth or interval. An empty input gives no rows.
    """
    tree, _ = ws.save(tree, "nodes")
    links, _ = ws.save(edges(tree), "edges")
    circles, caught = peel(links, ws)
    forest = tree.select("k").join(caught, "k", "left_anti").join(links.select(F.col("v").alias("k"), F.col("to").alias("p")), "k", "left")
    forest, _ = ws.save(forest, "forest")
    ranks = rank(tour(forest), ws)
    node, side = F.substring("el", 2, 2**31 - 1), F.substring("el", 1, 1)
    spans = ranks.groupBy(node.alias("k"), F.substring("last", 2, 2**31 - 1).alias("root")).agg(
        F.max(F.when(side == "<", F.col("len"))).alias("to_end"), F.max(F.when(side == ">", F.col("len"))).alias("after"), F.max(F.when(side == "<", -F.col("up"))).alias("depth")
    )
    spans, _ = ws.save(spans, "spans")
    length = spans.where("k = root").select("root", F.col("to_end").alias("total"))
    placed = spans.join(length, "root").select("k", "root", "depth", (F.col("total") - F.col("to_end")).alias("entry"), (F.col("total") - F.coalesce("after", F.col("to_end") - 1)).alias("exit"))
    out = (
        tree.join(placed, "k", "left")
        .join(circles.withColumn("on", F.lit(True)), "k", "left")
        .select("k", "p", "root", "depth", "entry", "exit", F.expr("(exit - entry - 1) div 2").alias("descendants"), F.coalesce("on", F.lit(False)).alias("cyclic"))
    )
    return ws.save(out, "hierarchy")[0]


def ancestor_pairs(spans: DataFrame) -> DataFrame:
    """(root, ancestor, ancestor_depth, k, depth) for each node and each proper ancestor, from entry and exit.

    Every interval is cut into aligned blocks of powers of two up to BLOCK_LEVELS, each position belongs to one block per
    level, and the two meet in an equi-join on (root, level, block): each pair exactly once, no range comparison.
    """
    placed = spans.where("root IS NOT NULL").select("k", "root", "depth", "entry", "exit")
    levels = placed.where("k = root").select("root", F.least(F.floor(F.log2(F.col("exit") + 1)), F.lit(BLOCK_LEVELS)).cast("int").alias("top"))
    blocks = (
        placed.where("exit - entry > 1")
        .select("root", F.col("k").alias("ancestor"), F.col("depth").alias("ancestor_depth"), (F.col("entry") + 1).alias("a"), F.col("exit").alias("b"))
        .withColumn("lvl", F.explode(F.expr(f"sequence(0, cast(least(floor(log2(b - a)), {BLOCK_LEVELS}) as int))")))
        .withColumn("size", F.expr("shiftleft(1L, lvl)"))
        .withColumn("l", F.expr("(a + size - 1) div size"))
        .withColumn("r", F.expr("b div size"))
        .where("l < r")
        .withColumn("blk", F.explode(F.expr(f"if(lvl = {BLOCK_LEVELS}, sequence(l, r - 1), filter(array(if(l % 2 = 1, l, null), if(r % 2 = 1, r - 1, null)), x -> x is not null))")))
        .select("root", "lvl", "blk", "ancestor", "ancestor_depth")
    )
    points = placed.where("k <> root").join(levels, "root").withColumn("lvl", F.explode(F.expr("sequence(0, top)"))).select("root", "lvl", F.expr("shiftright(entry, lvl)").alias("blk"), "k", "depth")
    return points.join(blocks, ["root", "lvl", "blk"]).select("root", "ancestor", "ancestor_depth", "k", "depth")


def paths(spans: DataFrame, sep: str = "/") -> DataFrame:
    """``spans`` with path: the keys from the root to the node, null where there is no root."""
    up = ancestor_pairs(spans).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("ancestor_depth", "ancestor"))).alias("above"))
    return spans.join(up, "k", "left").withColumn("path", F.when(F.col("root").isNotNull(), F.concat_ws(sep, F.coalesce(F.col("above.ancestor"), F.array().cast("array<string>")), "k"))).drop("above")


def circle_ids(df: DataFrame, id_col: str, key: Column, parent: Column, ws: Workspace) -> DataFrame:
    """The distinct ids, as stored, of the rows that are their own ancestors."""
    tree, _ = ws.save(nodes(df, key, parent), "nodes")
    circles, _ = peel(edges(tree), ws)
    return df.select(F.col(id_col).alias("id"), key.alias("k")).join(circles, "k", "left_semi").select("id").distinct()
