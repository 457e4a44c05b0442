"""What the operators of this subpackage share: durable intermediate tables (from the engine), batch slicing, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.blocks import give_back
from lodestone.plans.durable import durable as materialize
from lodestone.plans.durable import shared_dir

__all__ = ["as_bytes", "byte_slices", "connected_components", "give_back", "kept", "materialize", "shared_dir"]


_KEPT: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What a worker process keeps between tasks under a key: one thing at a time, until byte_slices is called without its key."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def byte_slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000, key: tuple | None = None) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose column has about `most` bytes at most, so that memory doesn't follow the batch's size.

    What another operator has `kept` in this process goes first; `key` is that of the caller's own.
    """
    if _KEPT and key not in _KEPT:
        _KEPT.clear()
        give_back()
    at, n, col = 0, batch.num_rows, batch.column(column)
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    total = 0
    for i in range(n):
        if total and total + sizes[i] > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += sizes[i]
    if n > at:
        yield batch.slice(at, n - at)
    give_back()


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def connected_components(edges: DataFrame, tag: str, rounds: int = 100) -> DataFrame:
    """(node, component) of an undirected graph given as edges (a, b) of longs; component is the smallest node of each part.

    Alternating large-star and small-star steps; each is an aggregation with partial sums and a join on the node, so a hub
    is split by the runtime's skew handling rather than gathered. Every round is written to the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, before = materialize(now, tag), None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), tag)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
