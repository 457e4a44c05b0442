"""Tables of artifacts as versions: rows are added with a sequence number, and the last of each key counts. Loads are filters; no file is changed."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.report import latest

RUN = "run_id string, started_at string, finished_at string, settings_hash string, stage_stats string, model_usage string"


def utc_now() -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def upsert(rows: DataFrame, path: str) -> None:
    """Adds rows; of equal keys those of the last upsert count."""
    rows.withColumn("_seq", F.lit(time.time_ns())).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str, key: str, *, ids: list[str] | None = None, where: dict | None = None, order: str | None = None) -> DataFrame:
    """The last version of each key; of `ids` only if they are given (none for an empty list), of rows that are equal in `where`, in order."""
    rows = latest(spark.read.parquet(path), key, "_seq").drop("_seq")
    if ids is not None:
        rows = rows.where(F.col(key).isin(*ids)) if ids else rows.where(F.lit(False))
    for column, value in (where or {}).items():
        rows = rows.where(F.col(column) == value)
    return rows.orderBy(order) if order else rows


def finish_run(spark: SparkSession, path: str, run_id: str, *, stage_stats: str = "{}", model_usage: str = "{}") -> None:
    """A new version of a run with its end and what it came to."""
    own = load(spark, path, "run_id", ids=[run_id]).withColumns({"finished_at": F.lit(utc_now()), "stage_stats": F.lit(stage_stats), "model_usage": F.lit(model_usage)})
    rows = own.collect()  # one row
    if not rows:
        raise ValueError(f"unknown run {run_id!r}")
    upsert(spark.createDataFrame(rows, RUN), path)
