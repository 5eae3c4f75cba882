"""Incremental runs over arriving files with Structured Streaming (each run takes what is new and ends)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions import coerce
from tidemark.functions.keys import symbol_key
from tidemark.sources import sinks


def arriving(spark: SparkSession, root: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files under a folder, in batches of bounded size."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(root)


def first_deliveries(records: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """Each key once while its first delivery is within the watermark; state older than ``delay`` is dropped.

    Rows behind the watermark are lost; ``run_first_deliveries`` keeps them.
    """
    return records.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", delay).dropDuplicatesWithinWatermark([key]).drop("__time")


def _timed(mentions: DataFrame) -> DataFrame:
    return mentions.withColumn("time", F.timestamp_seconds("created_utc")).withColumn("symbol", symbol_key("symbol")).where("symbol IS NOT NULL AND time IS NOT NULL")


def _counts() -> list[Column]:
    score = F.sum(F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    return [F.count("id").alias("chatter_count"), score.alias("score_sum"), F.avg(coerce.number("sentiment_score")).alias("sent_mean")]


def daily_counts(mentions: DataFrame, delay: str = "2 days") -> DataFrame:
    """(day, symbol, chatter_count, score_sum, sent_mean) of days that the watermark has passed.

    Rows of days that are closed already are lost and the last days wait for newer rows; ``run_daily_counts`` counts both.
    """
    out = _timed(mentions).withWatermark("time", delay).groupBy(F.window("time", "1 day").alias("w"), "symbol").agg(*_counts())
    return out.select(F.to_date("w.start").alias("day"), "symbol", "chatter_count", "score_sum", "sent_mean")


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that has arrived, exactly once across runs, and stop."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def run_daily_counts(mentions: DataFrame, store: str, out: str, checkpoint: str) -> StreamingQuery:
    """The table of ``daily_counts`` in ``out``, by day, of everything that has arrived, however late; then stop.

    Each batch is set aside in ``store`` and the days that it touches are counted anew from there, so a repeated batch
    changes nothing. ``store``, ``out`` and ``checkpoint`` belong together.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{store}/batch={batch_id}"
        rows = _timed(batch).select("id", "symbol", "score", "sentiment_score", F.to_date("time").alias("day"))
        rows.repartition("day").write.partitionBy("day").option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)
        days = sinks.stored_days(batch.sparkSession, path)
        if days:
            kept = batch.sparkSession.read.parquet(store).where(F.col("day").cast("string").isin(*sorted(days)))
            sinks.write_days(kept.groupBy("day", "symbol").agg(*_counts()), out, force=True)

    return mentions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_first_deliveries(records: DataFrame, key: str, out: str, checkpoint: str) -> StreamingQuery:
    """Each key once in ``out``, by batch, as it came in the first batch that has it, however late; then stop.

    The keys of earlier batches are read from ``out``, which belongs with ``checkpoint``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.dropDuplicates([key])
        if batch_id:
            before = batch.sparkSession.read.parquet(out).where(F.col("batch") < batch_id).select(F.col(key).alias("__key"))
            new = new.join(before, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
        new.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
