"""Near-duplicate vectors by int8 tile products with exact error bounds.

Only vectors with equal labels are compared. A vector is scaled to length one in double precision and rounded to int8 by a
scale of its own; what that leaves is rounded to int8 once more. The lengths e of what is left each time are kept with it. For unit
x = n + d, |d| = e, the cosine differs from the product of the rounded vectors by at most e_x |y'| + e_y |x'| + e_x e_y. Pairs whose
rounded product less that bound is at least the threshold are links, those whose product plus the bound is below it are none; the
pairs between take the second rounding's product, whose bound is some hundred times smaller; and the few that are still open are
joined with the whole vectors and computed in double precision. Products of int8 numbers are summed in single precision, which holds
them exactly up to 1040 components; longer vectors use double precision.

Equal vectors are one node with a weight. A label's nodes are dealt by a hash into chunks of CHUNK vectors, and each pair of
chunks is one task, so a task's memory is two chunks whatever a label holds. Only the two roundings and their bounds are shuffled, made
once for each node. A task returns each vector's number of links, links that connect what its sure pairs connect, and the open pairs,
never all pairs. Work grows with the square of a label's distinct vectors: that is what comparing all of them takes.

Null labels, null, empty or zero vectors and vectors with null or non-finite components link with nothing, not even with
copies. Vectors of different lengths don't link. Repeated vec_ids are rows of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import connected_components, materialize

THRESHOLD, CHUNK, TILE = 0.93, 16_384, 1024
#: Partitions of the pairs of chunks; with more pairs a task has several, one after the other.
MOST_TASKS = 100_000


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 rows and their scales; a row of zeros stays one."""
    scale = np.abs(x).max(1) / 127
    return np.rint(x / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8), scale


class Rounded:
    """Vectors by two roundings: q1 and q2 with scales s1 and s2, the lengths l1, l2 of the sums and upper bounds e1, e2 of what is left."""

    FIELDS = ("s1", "s2", "l1", "l2", "e1", "e2")

    def __init__(self, q1: np.ndarray, q2: np.ndarray, numbers: np.ndarray):
        self.q1, self.q2, self.numbers = q1, q2, numbers
        self.s1, self.s2, self.l1, self.l2, self.e1, self.e2 = numbers.T

    @classmethod
    def of(cls, unit: np.ndarray) -> Rounded:
        q1, s1 = _rounded(unit)
        near = q1 * s1[:, None]
        q2, s2 = _rounded(unit - near)
        nearer = near + q2 * s2[:, None]
        length = lambda x: np.linalg.norm(x, axis=1)
        left = [length(unit - x) * (1 + 1e-9) + 1e-12 for x in (near, nearer)]
        return cls(q1, q2, np.column_stack([s1, s2, length(near) * (1 + 1e-12), length(nearer) * (1 + 1e-12), *left]))

    def __len__(self) -> int:
        return len(self.q1)

    def __getitem__(self, rows) -> Rounded:
        return Rounded(self.q1[rows], self.q2[rows], self.numbers[rows])

    def nearer(self) -> np.ndarray:
        return self.q1 * self.s1[:, None] + self.q2 * self.s2[:, None]


def tile_links(a: Rounded, b: Rounded, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs that are links for sure, and of those that the roundings leave open."""
    kind = np.float32 if a.q1.shape[1] <= 1040 else np.float64
    product = (a.q1.astype(kind) @ b.q1.astype(kind).T).astype(np.float64) * a.s1[:, None] * b.s1
    slack = a.e1[:, None] * b.l1 + a.l1[:, None] * b.e1 + a.e1[:, None] * b.e1 + 1e-9
    sure = product - slack >= threshold
    si, sj = np.nonzero(sure)
    mi, mj = np.nonzero(~sure & (product + slack >= threshold))
    open_i, open_j = [], []
    sure_i, sure_j = [si], [sj]
    for k in range(0, len(mi), 65536):
        i, j = mi[k : k + 65536], mj[k : k + 65536]
        x, y = a[i], b[j]
        found = np.einsum("ij,ij->i", x.nearer(), y.nearer())
        bound = x.e2 * y.l2 + x.l2 * y.e2 + x.e2 * y.e2 + 1e-11
        yes, no = found - bound >= threshold, found + bound < threshold
        sure_i.append(i[yes])
        sure_j.append(j[yes])
        open_i.append(i[~yes & ~no])
        open_j.append(j[~yes & ~no])
    none = np.zeros(0, np.int64)
    return np.concatenate(sure_i), np.concatenate(sure_j), np.concatenate([none, *open_i]), np.concatenate([none, *open_j])


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Of the pairs only those that join parts not joined yet."""
    part = np.arange(n)
    for i, j in pairs:
        while len(i):
            open_ = part[i] != part[j]
            i, j = i[open_], j[open_]
            if not len(i):
                break
            yield int(i[0]), int(j[0])
            hub = part[i[0]]
            part[part == part[j[0]]] = hub
            # all that touch the hub join it at once
            near = np.r_[j[part[i] == hub], i[part[j] == hub]]
            own = np.r_[i[part[i] == hub], j[part[j] == hub]]
            first, at = np.unique(part[near], return_index=True)
            for p, k in zip(first.tolist(), at.tolist(), strict=True):
                if p != hub:
                    yield int(own[k]), int(near[k])
                    part[part == p] = hub


def chunk_links(left: Rounded, right: Rounded | None, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]], list[tuple[int, int]]]:
    """Weighted numbers of sure links, connecting links and open pairs among `left`, or (unless it is None) across to `right`."""
    shift = 0 if right is None else len(left)
    counts = np.zeros(len(left) + (0 if right is None else len(right)), np.int64)
    other = left if right is None else right
    open_: list[tuple[int, int]] = []

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for r in range(0, len(left), TILE):
            for c in range(r if right is None else 0, len(other), TILE):
                i, j, oi, oj = tile_links(left[slice(r, r + TILE)], other[slice(c, c + TILE)], threshold)
                i, j, oi, oj = i + r, j + c + shift, oi + r, oj + c + shift
                if right is None:
                    (i, j), (oi, oj) = (i[i < j], j[i < j]), (oi[oi < oj], oj[oi < oj])
                np.add.at(counts, i, weights[j])
                np.add.at(counts, j, weights[i])
                open_.extend(zip(oi.tolist(), oj.tolist(), strict=True))
                yield i, j

    return counts, list(_forest(len(counts), pairs())), open_


def unit_vectors(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column as numbers."""
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _round_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two roundings and the bounds of each node's vector."""
    for batch in batches:
        rounded, numbers = [], []
        for v in _vectors(batch.column("v")):
            own = Rounded.of(unit_vectors(v[None]))
            rounded.append(own.q1.tobytes() + own.q2.tobytes())
            numbers.append(own.numbers[0])
        keep = [batch.column(c) for c in ("label", "node", "weight", "dim")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(rounded, pa.binary()), pa.array(numbers, pa.list_(pa.float64()))], names=["label", "node", "weight", "dim", "q", "bounds"])


def _cosines(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, va, vb) the pairs (a, b) of at least the threshold, in double precision."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keep = [float((unit_vectors(x[None]) @ unit_vectors(y[None]).T)[0, 0]) >= threshold for x, y in zip(_vectors(batch.column("va")), _vectors(batch.column("vb")), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def embedding_links(vectors: DataFrame, *, threshold: float = THRESHOLD, chunk: int = CHUNK, vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("v", lambda x: x != 0)
    valid = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))
    rows = rows.withColumn("key", F.when(valid, F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))), 256)))
    table = materialize(rows.select("_row", "vec_id", "label", "key", F.when(valid, F.col("v")).alias("v")), "vectors")
    nodes = table.where("key is not null").groupBy("key").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.min("_row").alias("node"))
    nodes = materialize(nodes.withColumn("dim", F.size("v")), "vector-nodes")
    label_type = nodes.schema["label"].dataType.simpleString()
    own = nodes.select("label", "node", "weight", "dim", "v").mapInArrow(_round_nodes, f"label {label_type}, node bigint, weight bigint, dim int, q binary, bounds array<double>")
    own = materialize(own, "vector-rounded")
    # one row for each label and length
    sizes = materialize(nodes.groupBy("label", "dim").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / chunk)).alias("chunks")), "vector-sizes")
    tasks = sizes.agg(F.sum(F.col("chunks") * (F.col("chunks") + 1) / 2)).first()[0] or 1
    placed = own.join(sizes, ["label", "dim"]).withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks")))
    pairs = placed.select("label", "dim", "node", "weight", "q", "bounds", "c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("d"))
    pairs = pairs.select("label", "dim", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), (F.col("c") > F.col("d")).alias("right"), "node", "weight", "q", "bounds")

    def search(key: tuple, t: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        raw = np.frombuffer(b"".join(t.column("q").to_pylist()), np.int8).reshape(len(t), 2, dim)
        every = Rounded(raw[:, 0], raw[:, 1], np.array(t.column("bounds").to_pylist(), np.float64).reshape(len(t), -1))
        node, weight = t.column("node").to_numpy(), t.column("weight").to_numpy()
        right = t.column("right").to_numpy(zero_copy_only=False).astype(bool)
        if key[2].as_py() != key[3].as_py():
            order = np.argsort(right, kind="stable")
            every, node, weight, n = every[order], node[order], weight[order], int((~right).sum())
            counts, links, open_ = chunk_links(every[slice(0, n)], every[slice(n, None)], weight, threshold)
        else:
            counts, links, open_ = chunk_links(every, None, weight, threshold)
        some = np.flatnonzero(counts)
        both = [*links, *open_]
        a = np.r_[node[some], [node[i] for i, _ in both]].astype(np.int64)
        b = np.r_[np.full(len(some), -1), [node[j] for _, j in both]].astype(np.int64)
        n = np.r_[counts[some], np.zeros(len(links)), np.full(len(open_), -1)]
        return pa.table({"a": a, "b": b, "n": n.astype(np.int64)})

    dealt = pairs.repartition(int(min(tasks, MOST_TASKS)), "label", "dim", "a", "b")
    found = materialize(dealt.groupBy("label", "dim", "a", "b").applyInArrow(search, "a bigint, b bigint, n bigint"), "vector-links")
    # the open pairs, with their whole vectors
    vectors_of = lambda name, v: nodes.select(F.col("node").alias(name), F.col("v").alias(v))
    open_ = found.where("n < 0").select("a", "b").join(vectors_of("a", "va"), "a").join(vectors_of("b", "vb"), "b")
    exact = materialize(open_.mapInArrow(lambda x: _cosines(x, threshold), "a bigint, b bigint"), "vector-exact")
    weights = nodes.select(F.col("node").alias("b"), F.col("weight").alias("n"))
    both = exact.unionByName(exact.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weights, "b").select(F.col("a").alias("node"), "n")
    counts = found.where("b < 0").select(F.col("a").alias("node"), "n").unionByName(both).groupBy("node").agg(F.sum("n").alias("n"))
    found = found.where("n >= 0").select("a", "b").unionByName(exact)
    parts = connected_components(found.where("b >= 0").select("a", "b"), "vector-parts")
    named = nodes.select("key", "node", "weight", "least").join(counts, "node", "left").join(parts, "node", "left")
    named = named.withColumn("part", F.coalesce("component", "node"))
    least = named.groupBy("part").agg(F.min("least").alias("component_id"))
    named = named.join(least, "part").select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    component = F.coalesce("component_id", "vec_id")
    out = table.select("vec_id", "key").join(named, "key", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
