"""Annotation requests: a post with its comments in chunks, serialised as one JSON line per request."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions import text
from tidemark.functions.keys import thread_key
from tidemark.session import Workspace

#: The messages before the items of a request, by the version of the request form (fixed values).
LEAD = 'Return JSON only: {"results":[...]} with one output per INPUT ITEM, same order.\nBEGIN_INPUTS:\n'


GROUP_LEADS = {
    "v1": "You will receive JSON lines for multiple posts. Return a SINGLE JSON OBJECT with a 'results' array containing one object PER input post, in the SAME ORDER as provided. Do not include any extra text.\nBEGIN:\n",
    "v2": "Return ONE JSON object with a 'results' array, one entry PER input item, IN THE SAME ORDER.\nBEGIN:\n",
    "v3": LEAD,
}


def comments_of(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """The comments whose link names one of the posts."""
    return comments.join(posts.select(thread_key("id").alias("__k")).distinct(), thread_key("link_id") == F.col("__k"), "left_semi")


def with_ids(posts: DataFrame, ids: DataFrame) -> DataFrame:
    """The posts whose id a list names."""
    return posts.join(ids.select("id"), "id", "left_semi")


def with_context(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments with the text of their post of the same day, '' where there is none."""
    p = posts.select(F.col("day").alias("__d"), thread_key("id").alias("__k"), F.col("text").alias("context"))
    joined = comments.join(p, (F.col("day") == F.col("__d")) & (thread_key("link_id") == F.col("__k")), "left").drop("__d", "__k")
    return joined.withColumn("context", F.coalesce("context", F.lit("")))


def numbered(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """``df`` with pos (0-based) and chunk = pos div size within each group."""
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("pos", F.row_number().over(w) - 1).withColumn("chunk", F.expr(f"pos div {size}").cast("int"))


def numbered_globally(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` with pos (0-based) and part = pos div size over all rows, without a single-task window.

    The rows are stored, for the ranges are found by a pass of their own; then range-partitioned by ``order``, sorted and
    stored with their place in their partition, to which the sizes of the partitions before (one row each) are added.
    """
    spark = df.sparkSession
    ws = Workspace(spark, "numbered")
    rows, _ = ws.save(df, "rows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    placed = placed.withColumn("__m", F.monotonically_increasing_id() - F.shiftleft(F.col("__p").cast("bigint"), 33))
    stored, _ = ws.save(placed, "placed")
    ws.drop(rows)
    sizes = stored.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(F.col("__p").alias("__q"), F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return stored.join(F.broadcast(before), F.col("__p") == F.col("__q")).withColumn("pos", F.col("__b") + F.col("__m")).withColumn("part", F.expr(f"pos div {size}")).drop("__p", "__q", "__m", "__b")


def numbered_within(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """Like ``numbered``, for groups of any size: a group may span many partitions, its first place is subtracted."""
    placed = numbered_globally(df, [*group, *order], size)
    first = placed.groupBy(*(F.col(g).alias(f"__g{i}") for i, g in enumerate(group))).agg(F.min("pos").alias("__first"))
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    joined = placed.join(first, reduce(Column.__and__, same)).withColumn("pos", F.col("pos") - F.col("__first"))
    return joined.withColumn("chunk", F.expr(f"pos div {size}").cast("int")).drop("part", "__first", *(f"__g{i}" for i in range(len(group))))


def requests(posts: DataFrame, comments: DataFrame, prompt: str = "", model: str = "annotator", comments_per_request: int = 15, max_chars: int = 1500, max_output_tokens: int = 800, text_format: str = "json_object") -> DataFrame:
    """(sid, chunk, created_utc, items, custom_id, line): one request per post and chunk of its comments, in time order.

    The post's text is part of each of its requests; posts without text have none, posts without comments have one.
    """
    p = posts.select(F.col("id").alias("sid"), thread_key("id").alias("__k"), F.col("created_utc").alias("at"), text.clipped(F.col("text"), max_chars).alias("post")).where("post <> ''")
    c = comments.select(F.col("id").alias("cid"), thread_key("link_id").alias("__l"), F.coalesce("created_utc", F.lit(0)).cast("bigint").alias("created_utc"), text.clipped(F.col("text"), max_chars).alias("comment_text"))
    chunks = numbered_within(c.where("__l IS NOT NULL"), ["__l"], ["created_utc", "cid"], comments_per_request).groupBy("__l", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "cid", "comment_text", "created_utc"))).alias("cs"))
    joined = p.join(chunks, F.col("__k") == F.col("__l"), "left").withColumn("chunk", F.coalesce("chunk", F.lit(0)))
    post_item = F.to_json(F.struct(F.lit("submission").alias("kind"), F.col("sid").alias("submission_id"), F.col("post").alias("text")))

    def comment_item(x: Column) -> Column:
        return F.to_json(F.struct(F.lit("comment").alias("kind"), x["cid"].alias("comment_id"), F.col("sid").alias("submission_id"), x["comment_text"].alias("comment_text"), x["created_utc"].alias("created_utc")))

    empty = F.array().cast("array<string>")
    items = F.concat(F.array(post_item), F.coalesce(F.transform("cs", comment_item), empty))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = [F.lit(model).alias("model"), F.array(message("system", F.lit(prompt)), message("user", F.concat(F.lit(LEAD), F.concat_ws("\n", "items")))).alias("input"), F.lit(0).alias("temperature"), F.lit(max_output_tokens).alias("max_output_tokens")]
    if text_format != "none":
        body.append(F.struct(F.struct(F.lit(text_format).alias("type")).alias("format")).alias("text"))
    out = joined.select("sid", F.col("at").alias("created_utc"), "chunk", items.alias("items")).withColumn("custom_id", F.format_string("sub:%s:%04d", "sid", "chunk"))
    return out.withColumn("line", F.to_json(F.struct("custom_id", F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), F.struct(*body).alias("body")), {"ignoreNullFields": "false"}))


def manifest(requests_: DataFrame, per_part: int = 800) -> DataFrame:
    """(part, requests, docs) of the parts into which the requests are written, in the order of (created_utc, sid, chunk)."""
    placed = numbered_globally(requests_, ["created_utc", "sid", "chunk"], per_part)
    return placed.groupBy("part").agg(F.count(F.lit(1)).alias("requests"), F.sum(F.size("items")).alias("docs"))


def grouped_requests(docs: DataFrame, kind: str, version: str = "v3", prompt: str = "", model: str = "annotator", group_size: int = 16, max_chars: int = 1500, max_output_tokens: int = 800, text_format: str = "json_object", least_chars: int = 0, allow_etf: bool = False) -> DataFrame:
    """(day, chunk, docs, custom_id, line): the earlier request forms, which group the documents of a day.

    ``docs`` has day, id, created_utc, text and, for comments of version v3, link_id and context. v1 cuts texts and
    keeps empty ones; v2 drops empty ones and tests the least length before cutting; v3 cuts, strips, then tests.
    """
    whole = F.coalesce("text", F.lit(""))
    cut = text.clipped(whole, max_chars) if version == "v3" else F.substring(whole, 1, max_chars)
    rows = docs.withColumn("__text", cut)
    if version != "v1":
        rows = rows.where(F.col("__text") != "")
    if kind == "rc" and least_chars:
        rows = rows.where(F.length("__text" if version == "v3" else whole) >= least_chars)
    if version == "v1":
        item = F.struct(F.col("id").alias("submission_id"), F.col("__text").alias("text"))
    elif version == "v2":
        item = F.struct(F.col("id").alias("submission_id"), F.concat(F.lit("id="), "id", F.lit(f"\nallow_etf={str(allow_etf).lower()}\ntext:\n"), "__text").alias("user"))
    elif kind == "rs":
        item = F.struct(F.lit("submission").alias("kind"), F.col("id").alias("submission_id"), F.col("__text").alias("text"))
    else:
        item = F.struct(F.lit("comment").alias("kind"), F.col("id").alias("comment_id"), F.regexp_replace("link_id", "^t3_", "").alias("submission_id"), F.col("__text").alias("comment_text"), F.coalesce("context", F.lit("")).alias("submission_text"))
    placed = numbered_within(rows.select("day", "id", "created_utc", F.to_json(item, {"ignoreNullFields": "false"}).alias("item")), ["day"], ["created_utc", "id"], group_size)
    groups = placed.groupBy("day", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("g"), F.min_by("id", "pos").alias("first"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = [F.lit(model).alias("model"), F.array(message("system", F.lit(prompt)), message("user", F.concat(F.lit(GROUP_LEADS[version]), F.concat_ws("\n", F.col("g.item"))))).alias("input"), F.lit(0).alias("temperature")]
    if version != "v1":
        body.append(F.lit(max_output_tokens).alias("max_output_tokens"))
        if text_format != "none":
            body.append(F.struct(F.struct(F.lit(text_format).alias("type")).alias("format")).alias("text"))
    custom = F.concat_ws("_", F.col("day").cast("string"), "first") if version == "v1" else F.format_string(f"{kind}:%s:%s:%04d", F.col("day").cast("string"), "first", "chunk")
    out = groups.withColumn("custom_id", custom).withColumn("docs", F.size("g"))
    line = F.to_json(F.struct("custom_id", F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), F.struct(*body).alias("body")), {"ignoreNullFields": "false"})
    return out.select("day", "chunk", "docs", "custom_id", line.alias("line"))
