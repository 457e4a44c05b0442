"""Token ids in fixed-width bit-packed blocks, written in ascending doc_id order and read back.

A table of ids is a folder of Parquet files whose rows are blocks: part (the writing task, in doc_id order), block, first
(ids of the part before the block), n_tokens, bits, the doc_ids and their numbers of tokens, and a payload in which each id
takes the vocabulary's minimum bits, eight ids to `bits` bytes. Blocks hold whole documents, about BLOCK_TOKENS ids unless one
document has more, and are uncompressed, so that numpy unpacks any range of a block without reading the rest. read_token_range gives any ids
of the table and read_document_range any of a document, from the blocks that hold them alone.

Null text is an empty document, which still has its end token; null doc_ids come first; repeated rows are written once each, and
rows of one doc_id in order of a hash of their texts.
An empty table gives an empty table.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, shared_dir
from lodestone.llm.tokens import encoder

BLOCK_TOKENS = 1 << 16
PART_BYTES = 24_000_000
PARTS_A_SUM = 1024


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits (bits at most 32), little-endian bit order."""
    if not len(ids):
        return b""
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.ravel()[: len(ids)] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        wide = rows[:, j] << np.uint64(shift)
        for b in range(-(-(bits + shift) // 8)):
            out[:, at + b] |= ((wide >> np.uint64(8 * b)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(payload: bytes, bits: int, start: int, n: int) -> np.ndarray:
    """Ids start to start + n as unsigned 32-bit integers; only their groups of eight are read."""
    first, last = start // 8, -(-(start + n) // 8)
    packed = np.frombuffer(payload, np.uint8)[first * bits : last * bits].reshape(-1, bits)
    out = np.zeros((len(packed), 8), np.uint64)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        for b in range(-(-(bits + shift) // 8)):
            out[:, j] |= packed[:, at + b].astype(np.uint64) << np.uint64(8 * b)
        out[:, j] >>= np.uint64(shift)
    out &= np.uint64((1 << bits) - 1)
    return out.ravel()[start - 8 * first :][:n].astype(np.uint32)


def write_token_blocks(
    docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int, vocabulary: int, spaced: bool = False,
    block_tokens: int = BLOCK_TOKENS, part_bytes: int = PART_BYTES,
) -> None:
    docs = docs.select("doc_id", "text")
    bits, end = max(1, (vocabulary - 1).bit_length()), np.array([end_id], "<u4").tobytes()
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0] or 0
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer_path, spaced).encode, TaskContext.get().partitionId()
        state = {"block": 0, "first": 0}
        kind = None

        def flush(doc_ids: list, found: list[bytes]) -> pa.RecordBatch:
            sizes = [len(x) // 4 for x in found]
            row = [part, state["block"], state["first"], sum(sizes), bits, doc_ids, sizes, pack(np.frombuffer(b"".join(found), "<u4"), bits)]
            state["block"] += 1
            state["first"] += row[3]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

        doc_ids, found, size = [], [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for rows in byte_slices(batch, "text", 2_500_000, (tokenizer_path, spaced)):
                for doc, ids in zip(rows.column("doc_id").to_pylist(), encode(rows.column("text")), strict=True):
                    if found and size + len(ids) // 4 + 1 > block_tokens:
                        yield flush(doc_ids, found)
                        doc_ids, found, size = [], [], 0
                    doc_ids.append(doc)
                    found.append(ids + end)
                    size += len(found[-1]) // 4
        if found:
            yield flush(doc_ids, found)

    names = ["part", "block", "first", "n_tokens", "bits", "doc_ids", "sizes", "payload"]
    schema = f"part int, block int, first bigint, n_tokens bigint, bits int, doc_ids array<{id_type}>, sizes array<bigint>, payload binary"
    # the hash parts the rows of one doc_id, and no text is sampled for the ranges
    keyed = docs.withColumn("_order", F.xxhash64("text"))
    ordered = keyed.repartitionByRange(max(1, -(-total // part_bytes)), "doc_id", "_order").sortWithinPartitions("doc_id", "_order")
    ordered.drop("_order").mapInArrow(blocks, schema).write.option("compression", "uncompressed").parquet(path)


def _offsets(blocks: DataFrame) -> DataFrame:
    """(part, _before): the ids of all parts before each part, by sums of runs of PARTS_A_SUM parts, then within each run."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n")).withColumn("_run", F.floor(F.col("part") / PARTS_A_SUM))
    runs = parts.groupBy("_run").agg(F.sum("_n").alias("_all"))
    runs = runs.select("_run", (F.sum("_all").over(Window.orderBy("_run")) - F.col("_all")).alias("_runs_before"))  # one row for each 25 GB of text
    own = F.sum("_n").over(Window.partitionBy("_run").orderBy("part")) - F.col("_n")
    return parts.withColumn("_own", own).join(runs, "_run").select("part", (F.col("_own") + F.col("_runs_before")).alias("_before"))


def read_token_docs(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """One row for each document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for.

    Payloads are unpacked where they are read; only the documents' rows meet the parts' offsets.
    """
    blocks = spark.read.parquet(path)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i] for k in batch.schema.names}
                sizes = np.array(row["sizes"].as_py(), np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                raw = memoryview(unpack(row["payload"].as_py(), row["bits"].as_py(), 0, row["n_tokens"].as_py()).astype("<u4").tobytes())
                own = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                part = np.full(len(sizes), row["part"].as_py(), np.int32)
                arrays = [pa.array(part), row["doc_ids"].values, pa.array(starts + row["first"].as_py()), pa.array(sizes), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                if with_ids:
                    arrays.append(pa.array([bytes(x) for x in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"part int, doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    placed = blocks.mapInArrow(documents, schema).join(_offsets(blocks), "part")
    return placed.withColumn("start", F.col("start") + F.col("_before")).select(*names[1:])


def _slices(found: DataFrame) -> DataFrame:
    """(start, ids) from rows (start, lo, n, bits, payload): ids lo to lo + n of each payload."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, lo, n, bits = (batch.column(c).to_pylist() for c in ("start", "lo", "n", "bits"))
            ids = [unpack(batch.column("payload")[i].as_py(), bits[i], lo[i], n[i]).tolist() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(start, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["start", "ids"])

    return found.select("start", "lo", "n", "bits", "payload").mapInArrow(cut, "start bigint, ids array<bigint>")


def read_token_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, ids): the table's ids first to last (exclusive), a row for each block that holds some. Other blocks' payloads are not read."""
    blocks = spark.read.parquet(path)
    # the offsets take no payload; they say which blocks are asked for
    spots = blocks.select("part", "block", "first", "n_tokens").join(_offsets(blocks), "part").withColumn("at", F.col("_before") + F.col("first"))
    spots = spots.where((F.col("at") < last) & (F.col("at") + F.col("n_tokens") > first)).select("part", "block", "at")
    lo = F.greatest(F.lit(0), F.lit(first) - F.col("at"))
    found = blocks.join(spots, ["part", "block"]).withColumn("lo", lo).withColumn("n", F.least("n_tokens", F.lit(last) - F.col("at")) - F.col("lo")).withColumn("start", F.col("at") + F.col("lo"))
    return _slices(found)


def read_document_range(spark: SparkSession, path: str, doc_id: object, first: int, last: int) -> DataFrame:
    """(start, ids): ids first to last (exclusive) of each document of this doc_id; start counts from the document's first id."""
    own = F.transform("sizes", lambda n, i: F.struct(F.get("doc_ids", i).alias("doc"), (F.aggregate(F.slice("sizes", 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("at"), n.alias("size")))
    blocks = spark.read.parquet(path).where(F.array_contains("doc_ids", F.lit(doc_id)))
    rows = blocks.select("bits", "payload", F.explode(F.filter(own, lambda x: x["doc"] == F.lit(doc_id))).alias("d"))
    n = F.greatest(F.lit(0), F.least(F.lit(last), F.col("d.size")) - first)
    return _slices(rows.select("bits", "payload", F.lit(first).cast("bigint").alias("start"), (F.col("d.at") + first).alias("lo"), n.alias("n")).where("n > 0"))


def token_round_trip(docs: DataFrame, tokenizer_path: str, *, end_id: int, vocabulary: int, path: str | None = None, **kw) -> DataFrame:
    """Writes the blocks (to the shared folder unless a path is given) and reads the documents back from them."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_blocks(docs, path, tokenizer_path, end_id=end_id, vocabulary=vocabulary, **kw)
    return read_token_docs(spark, path)
