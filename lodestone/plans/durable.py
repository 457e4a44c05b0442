"""Tables in a shared folder that cut lineage between rounds of an iterative plan."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a local session without one gets its own, until the program ends."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        own = tempfile.mkdtemp(prefix="lodestone-")
        atexit.register(shutil.rmtree, own, True)
        shared_dir.own = f"file://{own}"
    return shared_dir.own


def durable(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: it cuts lineage, and it survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str | Column], name: str, rows_a_part: int = 1_000_000) -> DataFrame:
    """df with `name`, the place of each row from 1 in an order of all rows: sorted parts, and the sums of the parts before each."""
    parts = max(1, -(-df.count() // rows_a_part))
    # equal columns keep to one part, so `order` should end in a key
    sorted_ = durable(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "numbered")
    sizes = sorted_.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = sizes.select("_part", "_first", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each part
    return sorted_.join(before, "_part").withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_part", "_at", "_first", "_before")
