"""Sharding: a two-pass external shuffle into a fixed number of shards.

The first pass scatters records by seeded hashes into buckets that fit in memory: the shard is the highest of one seeded hash
for each shard (so another shard only takes rows into itself), and a second hash of the row's place splits a shard into
buckets. The second pass puts each bucket in a fixed order, shuffles it by Fisher-Yates with a seed of its own, and writes it.
Equal doc_ids share a shard; null doc_ids do so too, over all its buckets, as a row's place and not its id alone decides the bucket. So
the order inside a shard is fixed for one layout of the input, and another layout of the same rows gives another order. Null text is empty. Repeated rows keep one slot each.
An empty table gives no files and no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import shared_dir

BUCKET_BYTES = 16_000_000
#: With more buckets a task shuffles several, one after the other.
MOST_TASKS = 100_000


def rendezvous_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash with the key is highest. With one more shard a key stays or goes to the new one."""
    ranked = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"), s.alias("s")))
    return F.array_max(ranked)["s"].cast("int")


def write_shards(docs: DataFrame, path: str, *, shards: int = 40, seed: int = 23, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes docs (doc_id, text and any other columns) to path/shard=N and returns the files' rows.

    Added columns: shard, bucket, place (in the bucket, gapless from 0), grown_shard. Extra columns named like these are
    replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "bucket", "place", "grown_shard")
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    placed = docs.withColumns({
        "shard": rendezvous_shard(F.col("doc_id"), shards, seed),
        "grown_shard": rendezvous_shard(F.col("doc_id"), shards + 1, seed),
        "bucket": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", F.monotonically_increasing_id()), F.lit(buckets)).cast("int"),
        "_crc": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
    })
    columns = [*docs.columns, "shard", "bucket", "grown_shard"]

    def shuffle(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("_crc", "ascending")])
        rng = np.random.Generator(np.random.PCG64([seed, key[0].as_py(), key[1].as_py()]))
        order = np.arange(table.num_rows)
        rng.shuffle(order)  # Fisher-Yates
        return table.select(columns).take(pa.array(order)).append_column("place", pa.array(np.arange(table.num_rows, dtype=np.int64)))

    schema = placed.select(*columns).withColumn("place", F.lit(0).cast("bigint")).schema
    # about a bucket a task, whatever the session's number of partitions
    placed = placed.repartition(min(MOST_TASKS, shards * buckets), "shard", "bucket")
    placed.groupBy("shard", "bucket").applyInArrow(shuffle, schema).write.partitionBy("shard").parquet(path)
    return read_shards(spark, path, schema)


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def shard_slots(written: DataFrame) -> DataFrame:
    """Adds slot, gapless from 0 in each shard: the rows of earlier buckets, then the place in the bucket."""
    from pyspark.sql import Window

    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("shard", "bucket", (F.sum("_n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("_n")).alias("_before"))
    return written.join(before, ["shard", "bucket"]).withColumn("slot", F.col("_before") + F.col("place")).drop("_before")


def shard_documents(docs: DataFrame, *, path: str | None = None, shards: int = 40, seed: int = 23, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes the shards (to the shared folder unless a path is given) and returns their rows with slots."""
    path = path or f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    return shard_slots(write_shards(docs, path, shards=shards, seed=seed, bucket_bytes=bucket_bytes))
