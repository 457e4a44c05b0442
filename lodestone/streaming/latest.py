"""Streams of artifacts: counts in event-time windows, and the last version of each key in a table of versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.report import latest


def windowed_counts(events: DataFrame, *, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(start, event_type, n, total) from a stream of (ts, event_type, value); events later than the watermark are dropped."""
    own = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return own.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def append_versions(stream: DataFrame, path: str, checkpoint: str, key: str, seq: str) -> StreamingQuery:
    """Writes each batch's last version of each key to path/batch=N; a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, key, seq).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, path: str, key: str, seq: str) -> DataFrame:
    return latest(spark.read.parquet(path).drop("batch"), key, seq)
