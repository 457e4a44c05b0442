"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint's bit is 1 if it is set in over half the XXH64 hashes of the text's word shingles (repeats count). Fingerprints
within RADIUS bits are linked. Each bit position gets a vector over GF(2) with RADIUS + 1 parts; each nonzero vector v makes a
table, whose mask keeps the positions with an odd inner product. The vectors of RADIUS differing positions leave at least one v
orthogonal to all, so every pair within the radius agrees on all of some mask.

Equal fingerprints are one node, so copies cost nothing. A table's bucket of up to BUCKET fingerprints is searched in one task;
a larger one is split by masks on the positions that its own mask leaves free, with the same guarantee; after three levels a
bucket agrees on all but some 7 positions, so it can't hold over 256.

Null text has no words: fingerprint zero. Null doc_ids are never the smallest of a component that has others. Repeated rows
come back once each. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import minhash
from lodestone.llm.common import as_bytes, byte_slices, connected_components, materialize

RADIUS = 3
BUCKET = 8192


def fingerprint(text: bytes, words: int = 3) -> bytes:
    """Eight bytes, the highest bit first."""
    from xxhash import xxh64_digest

    own = text.lower().split()
    if not own:
        return bytes(8)
    joined = b" ".join(own)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(own) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = b"".join([xxh64_digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8 << 14):
        count += np.unpackbits(np.frombuffer(hashes[at : at + (8 << 14)], np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return np.packbits(2 * count > len(starts)).tobytes()


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp, a long with the fingerprint's bits."""
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                found = b"".join(fingerprint(x, words) for x in as_bytes(rows.column("text")))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.frombuffer(found, ">i8").astype(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions; any set of `radius` positions is outside at least one of them."""
    last = (1 << (radius + 1)) - 1
    vector = {p: i % last + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, last + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what the pairs within the radius connect: a search that leaves each node once."""
    left = fps
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= radius
            for y in left[near]:
                yield int(x), int(y)
            front += list(left[near])
            left = left[~near]


def bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """From rows (table, key, fp) sorted by table and key: links inside each bucket."""
    kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

    def search(cols: list[np.ndarray]) -> pa.RecordBatch | None:
        cut = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(cols[0])]
        fps, big = cols[2].astype(np.uint64), ends - starts > 16
        pairs = [p for s, e in zip(starts[big].tolist(), ends[big].tolist(), strict=True) for p in _links(fps[s:e], radius)]
        a, b = [np.array([p[0] for p in pairs], np.uint64)], [np.array([p[1] for p in pairs], np.uint64)]
        group = np.repeat(np.where(big, -1, np.arange(len(starts))), ends - starts)
        for lag in range(1, 16):
            same = np.flatnonzero((group[lag:] == group[:-lag]) & (group[lag:] >= 0))
            near = same[np.bitwise_count(fps[same] ^ fps[same + lag]) <= radius]
            a.append(fps[near])
            b.append(fps[near + lag])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

    for batch in batches:
        cols = [np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns, strict=True)]
        if not len(cols[0]):
            continue
        edge = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        at = int(edge[-1]) + 1 if len(edge) else 0  # the last bucket may go on in the next batch
        if at and (out := search([c[:at] for c in cols])):
            yield out
        kept = [c[at:] for c in cols]
    if len(kept[0]) and (out := search(kept)):
        yield out


def near_links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (a column fp), which connect all pairs within the radius."""
    spark = nodes.sparkSession
    masks = covering_masks(list(range(64)), radius)
    level = nodes.select("fp", F.explode(F.array([F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(masks)])).alias("x"))
    level = level.select("fp", F.col("x.t").cast("bigint").alias("t"), F.col("x.m").alias("m"))
    out = None
    for depth in range(3):
        level = level.withColumn("key", F.col("fp").bitwiseAND(F.col("m")))
        sizes = level.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
        rows = level.join(sizes, ["t", "key"])
        hot = sizes.where(F.col("n") > bucket).limit(1).count() if depth < 2 else 0
        small = (rows.where(F.col("n") <= bucket) if depth < 2 else rows).select("t", "key", "fp")
        found = small.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(lambda x: bucket_links(x, radius), "a bigint, b bigint")
        out = found if out is None else out.unionByName(found)
        if not hot:
            return out
        tables = [(t, _signed(m)) for t, m in ((r.t, r.m & ((1 << 64) - 1)) for r in level.select("t", "m").distinct().collect())]  # 15 or 225 rows
        deeper = []
        for t, m in tables:
            free = [p for p in range(64) if not m >> p & 1]
            deeper += [(t, t * 15 + s, _signed((m | x) & ((1 << 64) - 1))) for s, x in enumerate(covering_masks(free, radius))]
        below = F.broadcast(spark.createDataFrame(deeper, "t bigint, t2 bigint, m bigint"))
        level = rows.where(F.col("n") > bucket).select("t", "fp").join(below, "t").select("fp", F.col("t2").alias("t"), "m")
    return out


def _components(nodes: DataFrame, radius: int, bucket: int) -> DataFrame:
    """fp, least and the component's smallest least, from fp and least (any type with an order)."""
    links = near_links(nodes.select("fp"), radius, bucket)
    parts = connected_components(links, "simhash-links")
    joined = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", F.coalesce("component", "fp").alias("part"), "least")
    least = joined.groupBy("part").agg(F.min("least").alias("first"))
    return joined.join(least, "part").select("fp", "least", "first")


def simhash_groups(docs: DataFrame, *, words: int = 3, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    found = materialize(fingerprints(docs, words), "simhash")
    named = _components(found.groupBy("fp").agg(F.min("doc_id").alias("least")), radius, bucket).select("fp", F.col("first").alias("component_id"))
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, words: int = minhash.WORDS, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """The documents with one of each group of near-duplicates: the one with the smallest doc_id (null last), then the smallest SHA-256 of its text.

    Near-duplicates have a Jaccard similarity of at least 0.8 on distinct shingles of `words` words. Candidates come from the covering
    masks on fingerprints of those shingles first, then from `minhash`, as a pair of 0.8 is mostly further apart than any radius that
    masks can cover; whole sets of shingles decide about both. Texts of equal words are one node. Null text has no words, and all texts
    without words are one node. Repeated rows come back once. All columns stay, whatever they are called. An empty table gives an empty table.
    """
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    ids = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), key.alias("k"))
    found = materialize(minhash.sketches(docs.select(ids.alias("id"), "text"), words), "near")
    nodes = found.groupBy("word_key").agg(F.min("id").alias("least"), *[F.first(c).alias(c) for c in ("size", "keys", "sig", "fp")])
    nodes = materialize(nodes.drop("word_key").withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    heads = materialize(nodes.groupBy("fp").agg(F.min("node").alias("head")), "near-prints")
    links = near_links(heads.select("fp"), radius, bucket).distinct()
    named = links.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    same = nodes.select("node", "fp").join(heads, "fp").where("node <> head")
    first = named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).unionByName(same.select(F.col("head").alias("a"), F.col("node").alias("b")))

    def sets_of(some: DataFrame) -> DataFrame:
        keyed = docs.select(F.col("doc_id").alias("i"), key.alias("k"), "text")
        own = some.select("node", F.col("least.i").alias("li"), F.col("least.k").alias("lk"))
        texts = keyed.join(own, (keyed["k"] == own["lk"]) & keyed["i"].eqNullSafe(own["li"]))
        return minhash.shingle_sets(texts.select("node", "text"), words).dropDuplicates(["node"])

    parts = minhash.near_components(nodes.select("node", "size", "keys", "sig", "least"), first.distinct(), sets_of)
    joined = nodes.select("node", "least").join(parts, "node", "left").select(F.coalesce("component", "node").alias("part"), "least")
    kept = joined.groupBy("part").agg(F.min("least").alias("first")).select(F.col("first.i").alias("i"), F.col("first.k").alias("k"))
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"), key.alias("key"))
    chosen = keyed.join(kept, (keyed["key"] == kept["k"]) & keyed["id"].eqNullSafe(kept["i"]), "left_semi")
    return chosen.dropDuplicates(["id", "key"]).select("doc.*")
