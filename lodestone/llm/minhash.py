"""Near-duplicate texts by a Jaccard similarity of at least 0.8 on distinct five-word shingles: what SimHash's radius can't reach.

A pair of texts of similarity 0.8 differs in some ten of 64 bits of its SimHash fingerprints (measured in the README), too many for a
covering family of masks. `simhash.keep_one` therefore takes its first candidates from covering masks and the others from here.

A text is lower-cased (A-Z) and cut at white space; its shingles are runs of five words (all words if it has fewer), known by their
XXH64 hashes. Each of BANDS keys hashes ROWS minima, so a pair of similarity 0.8 shares no key with a chance of (1 - 0.8^3)^20 =
6e-7, and less above. Pairs that share a key, agree in half of all minima (a pair of 0.8 has fewer with a chance of 3e-7) and have sizes
that allow a similarity of 0.8 are candidates. A bucket gives only a forest that connects its candidates, so rows grow with its members;
what the forests connect is a cluster. The whole sets of a cluster's texts meet in chunks of bounded bytes, each pair of chunks in one
task, where exact intersections decide; a task returns a forest of the links, never all pairs. Clusters whose members are linked
already are left out. Work within a cluster grows with the square of its distinct texts; nothing is cut or left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.blocks import groups_of, list_rows, shared_counts
from lodestone.llm.common import as_bytes, byte_slices, connected_components, materialize

WORDS, BANDS, ROWS = 5, 20, 3
AGREE = BANDS * ROWS // 2
#: Texts and shingles in a chunk of a cluster, about.
CHUNK, CHUNK_SHINGLES = 1024, 1_000_000
_SALT, _ODD = np.random.default_rng(20).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
_ODD |= np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def all_shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of the shingles, in order, repeats included."""
    from xxhash import xxh64_intdigest

    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(own) - words + 1)
    starts, ends = starts[:n], ends[-n:]
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of the distinct shingles, ascending."""
    return np.unique(all_shingles(text, words))


def majority_bits(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: the bits that are set in over half of them, as a signed number."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        raw = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8)
        count += np.unpackbits(raw).reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes)).view(">i8")[0]) if len(hashes) else 0


def minima(hashes: np.ndarray) -> np.ndarray:
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        out = np.minimum(out, ((hashes[at : at + 4096, None] ^ _SALT) * _ODD).min(0))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = (key ^ least[j::ROWS]) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """id, word_key (128 bits of a hash of the words), size (of the set), keys, a byte of each minimum, and fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for rows in byte_slices(batch, "text"):
                word_key, size, keys, sig, fp = [], [], [], [], []
                for x in as_bytes(rows.column("text")):
                    every = all_shingles(x, words)
                    own = np.unique(every)
                    least = minima(own)
                    word_key.append(xxh3_128_digest(b" ".join(x.lower().split()), 7))
                    size.append(len(own))
                    keys.append(band_keys(least))
                    sig.append((least >> np.uint64(24)).astype(np.uint8).tobytes())
                    fp.append(majority_bits(every))
                flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), flat)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(word_key, pa.binary()), pa.array(size, pa.int32()), lists, pa.array(sig, pa.binary()), pa.array(fp, pa.int64())],
                    names=["id", "word_key", "size", "keys", "sig", "fp"],
                )

    return docs.select("id", "text").mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, word_key binary, size int, keys array<bigint>, sig binary, fp bigint")


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, s) from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                own = [shingles(x, words).view(np.int64) for x in as_bytes(rows.column("text"))]
                yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(own, pa.list_(pa.int64()))], names=["node", "s"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, s array<bigint>")


def sketch_forest(size: np.ndarray, sig: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places (i, js) of candidate pairs that connect what all candidate pairs connect."""
    left = np.arange(len(size))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            x = front.pop()
            fits = 10 * np.minimum(size[left], size[x]) >= 8 * np.maximum(size[left], size[x])
            near = fits & ((sig[left] == sig[x]).sum(1) >= AGREE)
            if near.any():
                yield x, left[near]
                front += left[near].tolist()
                left = left[~near]


def candidate_forest(buckets: DataFrame) -> DataFrame:
    """(a, b) of a forest over the candidates of each bucket, from rows key, node, size, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in groups_of(batches, ["key"]):
            if len(own) < 2:
                continue
            node, size = own.column("node").to_numpy(), own.column("size").to_numpy().astype(np.int64)
            sig = np.frombuffer(b"".join(own.column("sig").to_pylist()), np.uint8).reshape(len(own), -1)
            for i, js in sketch_forest(size, sig):
                other = node[js]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(other, node[i])), pa.array(np.maximum(other, node[i]))], names=["a", "b"])

    dealt = buckets.select("key", "node", "size", "sig").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def exact_forest(part: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (i, j) those that join parts which weren't joined yet."""
    up = {int(p): int(p) for p in set(part.tolist())}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = root(int(part[a])), root(int(part[b]))
        if x != y:
            up[x] = y
            out.append((a, b))
    return out


def cluster_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of links of at least 0.8 between parts, from (cluster, node, part, size); a forest for each pair of chunks."""
    sizes = placed.groupBy("cluster").agg(
        (F.min("part") < F.max("part")).alias("open"), F.greatest(F.lit(1), F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("size") / CHUNK_SHINGLES)).cast("bigint").alias("chunks"),
    )
    rows = placed.join(sizes.where("open"), "cluster").withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks")))
    rows = rows.join(sets, "node").select("cluster", "node", "part", "s", "c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("d"))
    rows = rows.select("cluster", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), (F.col("c") > F.col("d")).cast("int").alias("side"), "node", "part", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in groups_of(batches, ["cluster", "a", "b"]):
            node, part, side = (own.column(c).to_numpy() for c in ("node", "part", "side"))
            if len(own) < 2 or (part == part[0]).all():
                continue
            inside = own.column("a")[0].as_py() == own.column("b")[0].as_py()
            n_left = len(own) if inside else int((side == 0).sum())
            if not n_left or (not inside and n_left == len(own)):
                continue
            found = list_rows(own.column("s"))
            size = np.fromiter(map(len, found), np.int64, len(found))
            shared = shared_counts(found, n_left)
            start = 0 if inside else n_left
            near = 9 * shared >= 4 * (size[:n_left, None] + size[start:])
            near &= part[:n_left, None] != part[start:]
            i, j = np.nonzero(near)
            kept = exact_forest(part, i, j + start)
            if kept:
                a, b = np.array(kept).T
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    dealt = rows.repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b", "side")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with a Jaccard similarity of at least 0.8: nine times what they share is at least four times the sum of their sizes."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(9 * shared >= 4 * (F.size("sa") + F.size("sb"))).select("a", "b")


def near_components(nodes: DataFrame, first: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of texts linked by a similarity of at least 0.8; nodes(node, size, keys, sig) are distinct texts.

    `first` are candidate pairs (a, b) from another search, which is asked before the clusters; sets_of gives (node, s) for nodes.
    """
    bands = nodes.select("node", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = materialize(bands.join(shared, "key"), "minhash-buckets")
    first = materialize(first, "minhash-first")
    asked = buckets.select("node").unionByName(first.select(F.col("a").alias("node"))).unionByName(first.select(F.col("b").alias("node"))).distinct()
    some = materialize(nodes.join(asked, "node", "left_semi").drop("keys"), "minhash-nodes")
    forest = materialize(candidate_forest(buckets.join(some.select("node", "size", "sig"), "node")), "minhash-forest")
    clusters = connected_components(forest, "minhash-clusters")
    wanted = clusters.select("node").unionByName(first.select(F.col("a").alias("node"))).unionByName(first.select(F.col("b").alias("node"))).distinct()
    sets = materialize(sets_of(some.join(wanted, "node", "left_semi")), "minhash-sets")
    links = materialize(similar(first, sets), "minhash-links")
    parts = connected_components(links, "minhash-parts")
    placed = clusters.select("node", F.col("component").alias("cluster")).join(parts, "node", "left").join(some.select("node", "size"), "node")
    placed = materialize(placed.select("cluster", "node", F.coalesce("component", "node").alias("part"), "size"), "minhash-placed")
    more = materialize(cluster_links(placed, sets), "minhash-more")
    return connected_components(links.unionByName(more), "minhash-parts")
