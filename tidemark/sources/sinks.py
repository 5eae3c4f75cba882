"""Sinks: day-partitioned tables with skip-existing or overwrite semantics, JSON lines in parts, lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.requests import numbered_globally
from tidemark.sources import files


def stored_days(spark: SparkSession, root: str) -> set[str]:
    """The days that a table already has, from its folder names alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName()[4:] for s in fs.listStatus(path) if s.getPath().getName().startswith("day=")} if fs.exists(path) else set()


def write_days(df: DataFrame, root: str, force: bool = False, max_records: int = 0) -> None:
    """Write by day. Days that exist are left alone; with ``force`` exactly the days at hand are replaced, never doubled."""
    spark = df.sparkSession
    if not force:
        done = sorted(stored_days(spark, root))
        df = df.where(~F.col("day").cast("string").isin(*done)) if done else df
    writer = df.repartition("day").write.partitionBy("day").option("compression", "zstd")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic").parquet(root)


def append_new(df: DataFrame, root: str, keys: list[str]) -> None:
    """Append the rows whose key is not stored yet."""
    stored = stored_days(df.sparkSession, root)
    new = df.join(df.sparkSession.read.parquet(root).select(*keys), keys, "left_anti") if stored else df
    new.write.partitionBy("day").option("compression", "zstd").mode("append").parquet(root)


def write_single(df: DataFrame, path: str) -> None:
    """One file for a bounded range (the caller answers for its size)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_parts(rows: DataFrame, order: list[str], root: str, per_part: int) -> DataFrame:
    """Column ``line`` in files part-NNNNN.jsonl of at most ``per_part`` lines, in ``order``; the rows with their part.

    Each part is written by one task; only the finished files are moved on the driver.
    """
    spark, at = rows.sparkSession, f"{root}/_parts"
    placed = numbered_globally(rows, order, per_part)
    placed.repartition("part").sortWithinPartitions("part", "pos").select("part", F.col("line").alias("value")).write.mode("overwrite").partitionBy("part").text(at)
    for only in files.matching(spark, f"{at}/part=*/part-*"):
        part = int(only.rsplit("/", 2)[1].removeprefix("part="))
        files.move(spark, only, f"{root}/part-{part:05d}.jsonl")
    files.remove(spark, at)
    return placed


def write_request_parts(requests: DataFrame, root: str, per_part: int = 800) -> list[dict]:
    """The requests in parts, oldest first; and the entries of their manifest."""
    placed = write_parts(requests, ["created_utc", "sid", "chunk"], root, per_part)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("requests"), F.sum(F.size("items")).alias("docs")).orderBy("part")
    return [{"part": r["part"], "requests": r["requests"], "docs": r["docs"], "path": f"{root}/part-{r['part']:05d}.jsonl"} for r in parts.toLocalIterator()]


def write_manifest(spark: SparkSession, rows: list[dict], path: str, **about: str | int | None) -> None:
    """The parts with their totals and what else is known of the run (kind, days, comments per request)."""
    whole = {**about, "parts": rows, "requests": sum(r["requests"] for r in rows), "docs": sum(r["docs"] or 0 for r in rows)}
    files.write_text(spark, path, json.dumps(whole, indent=2))


def write_ids(ids: DataFrame, root: str) -> None:
    """Failed ids as JSON lines."""
    ids.select("id").write.mode("overwrite").json(root)


def write_symbols(symbols: DataFrame, root: str) -> None:
    """Missing symbols, one per line."""
    symbols.select("symbol").write.mode("overwrite").text(root)
