"""Queries p1, p3 and p4 over the tables of the social text and price pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import month_of_epoch, strip, symbol_key, thread_key
from tidemark.operators import hierarchy, references, rolling
from tidemark.session import Workspace, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """(id): the comments that are their own ancestors."""
    c = table(spark, d, "comments").select("id", "parent_id")
    return hierarchy.circle_ids(c, "id", thread_key("id"), thread_key("parent_id"), Workspace(spark, "p1"))


def _comment_forest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "comments").select("id", "parent_id")
    return hierarchy.hierarchy(hierarchy.nodes(c, thread_key("id"), thread_key("parent_id")), Workspace(spark, "p1"))


def p1_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """(id, root, depth, path, descendants, cyclic) of each comment; root and path start at the thread's top comment."""
    return hierarchy.paths(_comment_forest(spark, d)).select(F.col("k").alias("id"), "root", "depth", "path", "descendants", "cyclic")


def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    """(ancestor, id, distance) for each comment and each comment above it."""
    return hierarchy.ancestor_pairs(_comment_forest(spark, d)).select("ancestor", F.col("k").alias("id"), (F.col("depth") - F.col("ancestor_depth")).alias("distance"))


def p3_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Totals and averages of chatter and engagement over the last 7 and 30 days, per symbol and calendar day."""
    out = rolling.trailing(table(spark, d, "reddit_daily"), "symbol", "day", ["chatter_count", "engagement_sum"], [7, 30])
    return out.select("symbol", "day", "active", *(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes[3:]))


def _references(spark: SparkSession, d: str) -> list[tuple[str, DataFrame, DataFrame]]:
    """(source table, its references, its orphans)."""
    gone = lambda c: F.coalesce(F.lower(strip(c)).isin("[removed]", "[deleted]"), F.lit(False))
    void = gone("selftext") & (F.col("author").isNull() | (F.lower(strip("author")) == "[deleted]"))
    valid = table(spark, d, "submissions").where(~void).groupBy(thread_key("id").alias("key")).agg(F.min("batch_no").cast("long").alias("first_batch"))
    comments = references.distinct_references(table(spark, d, "comments"), thread_key("link_id"), month_of_epoch("created_utc"), F.col("batch_no"))
    exploded = references.distinct_references(table(spark, d, "exploded"), thread_key("submission_id"), F.date_format("__day__", "yyyy-MM"))
    day = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    prices = references.distinct_references(table(spark, d, "prices"), symbol_key("symbol"), F.date_format("day", "yyyy-MM"), day)
    listed = table(spark, d, "symbol_list").groupBy(symbol_key("symbol").alias("key")).agg(F.max(F.coalesce(F.datediff(F.col("listed_until"), F.lit("1970-01-01").cast("date")), F.lit(10**7))).alias("until"))
    return [
        ("comments", comments, references.orphans(comments, valid, F.col("p.first_batch") <= F.col("r.since"))),
        ("exploded", exploded, references.orphans(exploded, valid)),
        ("prices", prices, references.orphans(prices, listed, F.col("r.since") <= F.col("p.until"))),
    ]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """(source_table, period, ref_key) of each orphan reference; a row whose delivery or day is null is an orphan."""
    return reduce(DataFrame.unionByName, [missing.select(F.lit(name).alias("source_table"), "period", F.col("key").alias("ref_key")).distinct() for name, _, missing in _references(spark, d)])


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """References and orphans per table and month."""
    return reduce(DataFrame.unionByName, [references.orphan_report(refs, missing, name) for name, refs, missing in _references(spark, d)])


QUERIES = {f.__name__: f for f in (p1_found, p1_hierarchy, p1_descendants, p3_rolling, p4_found, p4_report)}

_BARE = r"nullif(regexp_replace(regexp_replace(lower({}), '^\s+|\s+$', '', 'g'), '^t[13]_', ''), '')"
_UPPER = r"nullif(upper(regexp_replace({}, '^\s+|\s+$', '', 'g')), '')"
_TREE = f"""nodes AS (SELECT {_BARE.format('id')} AS k, min({_BARE.format('parent_id')}) AS p FROM comments GROUP BY 1),
  forest AS (SELECT n.k, m.k AS p FROM nodes n LEFT JOIN nodes m ON n.p = m.k),
  tree AS (SELECT k, p, k AS root, 0 AS depth, k AS path FROM forest WHERE p IS NULL
           UNION ALL SELECT f.k, f.p, t.root, t.depth + 1, t.path || '/' || f.k FROM forest f JOIN tree t ON f.p = t.k),
  pairs AS (SELECT k, p AS anc, 1 AS distance FROM tree WHERE p IS NOT NULL
            UNION ALL SELECT q.k, t.p, q.distance + 1 FROM pairs q JOIN tree t ON q.anc = t.k WHERE t.p IS NOT NULL)"""
_CIRCLES = """below AS (SELECT f.k, f.p AS anc, 1 AS steps FROM forest f WHERE f.k NOT IN (SELECT k FROM tree) AND f.p IS NOT NULL
            UNION SELECT b.k, f.p, 0 FROM below b JOIN forest f ON b.anc = f.k),
  circles AS (SELECT DISTINCT k FROM below WHERE k = anc)"""
_FIRST = f"""valid AS (SELECT {_BARE.format('id')} AS k, min(batch_no) AS first_batch FROM submissions
     WHERE NOT (coalesce(lower(trim(selftext)) IN ('[removed]', '[deleted]'), false) AND (author IS NULL OR lower(trim(author)) = '[deleted]')) GROUP BY 1),
  listed AS (SELECT {_UPPER.format('symbol')} AS k, max(coalesce(listed_until, DATE '9999-01-01')) AS until FROM symbol_list GROUP BY 1),
  refs AS (
    SELECT 'comments' AS source_table, strftime(make_timestamp(created_utc * 1000000), '%Y-%m') AS period, {_BARE.format('link_id')} AS k,
           NOT EXISTS (SELECT 1 FROM valid v WHERE v.k = {_BARE.format('c.link_id')} AND v.first_batch <= c.batch_no) AS orphan FROM comments c
    UNION ALL SELECT 'exploded', strftime(__day__, '%Y-%m'), {_BARE.format('submission_id')},
           NOT EXISTS (SELECT 1 FROM valid v WHERE v.k = {_BARE.format('e.submission_id')}) FROM exploded e
    UNION ALL SELECT 'prices', strftime(day, '%Y-%m'), {_UPPER.format('symbol')},
           NOT EXISTS (SELECT 1 FROM listed l WHERE l.k = {_UPPER.format('p.symbol')} AND p.day <= l.until) FROM prices p)"""


def _rolled(v: str) -> str:
    return ", ".join(f"round(sum({v}) OVER w{p}, 6)::{t} AS {v}_sum_{p}, round(avg({v}) OVER w{p}, 6) AS {v}_avg_{p}" for p in (7, 30) for t in ["BIGINT" if v == "chatter_count" else "DOUBLE"])


ORACLE = {
    "p1_found": f"WITH RECURSIVE {_TREE}, {_CIRCLES} SELECT DISTINCT id FROM comments WHERE {_BARE.format('id')} IN (SELECT k FROM circles)",
    "p1_hierarchy": f"""WITH RECURSIVE {_TREE}, {_CIRCLES}
      SELECT n.k AS id, t.root, t.depth::BIGINT AS depth, t.path, CASE WHEN t.k IS NOT NULL THEN coalesce(a.n, 0) END::BIGINT AS descendants, n.k IN (SELECT k FROM circles) AS cyclic
      FROM nodes n LEFT JOIN tree t USING (k) LEFT JOIN (SELECT anc AS k, count(*) AS n FROM pairs GROUP BY 1) a USING (k)""",
    "p1_descendants": f"WITH RECURSIVE {_TREE} SELECT anc AS ancestor, k AS id, distance::BIGINT AS distance FROM pairs",
    "p3_rolling": f"""WITH once AS (SELECT DISTINCT * FROM reddit_daily),
      daily AS (SELECT symbol, day, sum(chatter_count) AS chatter_count, sum(engagement_sum) AS engagement_sum FROM once GROUP BY ALL),
      cal AS (SELECT symbol, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM daily GROUP BY symbol),
      dense AS (SELECT symbol, day, d.day IS NOT NULL AS active, coalesce(chatter_count, 0)::BIGINT AS chatter_count, coalesce(engagement_sum, 0) AS engagement_sum FROM cal LEFT JOIN daily d USING (symbol, day))
      SELECT symbol, day, active, chatter_count, round(engagement_sum, 6) AS engagement_sum, {_rolled('chatter_count')}, {_rolled('engagement_sum')} FROM dense
      WINDOW w7 AS (PARTITION BY symbol ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY symbol ORDER BY day ROWS 29 PRECEDING)""",
    "p4_found": f"WITH {_FIRST} SELECT DISTINCT source_table, period, k AS ref_key FROM refs WHERE orphan AND k IS NOT NULL",
    "p4_report": f"""WITH {_FIRST} SELECT source_table, period, count(*) AS refs, count(DISTINCT k) AS keys,
      count(*) FILTER (WHERE orphan) AS orphan_refs, count(DISTINCT k) FILTER (WHERE orphan) AS orphan_keys FROM refs WHERE k IS NOT NULL GROUP BY 1, 2""",
}
