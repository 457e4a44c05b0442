"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

Null text is an empty document, which still has its end token. Documents longer than a sequence are cut into full
sequences and a remainder; others stay whole. Repeated rows are packed once each. An empty table gives an empty table.
Only the tokenised lengths are shuffled, never texts or ids (unless ids are asked for).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lodestone.llm.common import byte_slices
from lodestone.llm.tokens import encoder

DOCS_PER_GROUP = 4096
GROUPS_PER_TASK = 8
MOST_TASKS = 100_000


class TournamentTree:
    """The leftmost bin with room for an item, in logarithmic time: each inner node holds the larger room of its children."""

    def __init__(self, leaves: int, room: int):
        self.n = 1 << max(0, leaves - 1).bit_length()
        self.best = [room] * (2 * self.n)

    def place(self, size: int) -> tuple[int, int]:
        """The bin and its room before; the caller makes sure that there are enough bins."""
        best, i = self.best, 1
        while i < self.n:
            i *= 2
            if best[i] < size:
                i += 1
        had = best[i]
        best[i] = had - size
        at = i - self.n
        while i > 1:
            i //= 2
            new = max(best[2 * i], best[2 * i + 1])
            if best[i] == new:
                break
            best[i] = new
        return at, had


def first_fit_decreasing(sizes: list[int], room: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item; larger items first, ties in the given order."""
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    tree = TournamentTree(len(sizes), room)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at, had = tree.place(sizes[i])
        out[i] = (at, room - had)
    return out


def _mix(seed: int, part: int, n: int, first: int) -> np.ndarray:
    """A hash of each of n row places, so that equal rows don't meet in one group."""
    with np.errstate(over="ignore"):
        x = np.arange(first, first + n, dtype=np.uint64) + np.uint64(part << 40) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        return x ^ (x >> np.uint64(31))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, *, sequence_tokens: int = 2048, end_id: int = 1, spaced: bool = True,
    docs_per_group: int = DOCS_PER_GROUP, seed: int = 17, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for."""
    docs = docs.select("doc_id", "text")
    groups = max(1, -(-docs.count() // docs_per_group))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer_path, spaced).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in byte_slices(batch, "text", 1_000_000, (tokenizer_path, spaced)):
                out: list[list] = [[] for _ in range(7)]
                keys = (_mix(seed, part, rows.num_rows, seen) % np.uint64(groups)).astype(np.int64).tolist()
                seen += rows.num_rows
                found = encode(rows.column("text"))
                for doc, ids, key in zip(rows.column("doc_id").to_pylist(), found, keys, strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, sequence_tokens):
                        own = ids[4 * start : 4 * (start + sequence_tokens)]
                        for to, x in zip(out, (doc, start, len(own) // 4, zlib.crc32(own), n, key, own), strict=True):
                            to.append(x)
                kinds = [rows.schema.field("doc_id").type, *[pa.int64()] * 5, pa.binary()]
                arrays = [pa.array(x, t) for x, t in zip(out, kinds, strict=True)]
                keep = [*range(5), *[6] * with_ids, 5]
                yield pa.RecordBatch.from_arrays([arrays[i] for i in keep], names=[*names, "_group"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        placed = first_fit_decreasing(table.column("length").to_pylist(), sequence_tokens)
        base = key[0].as_py() << 32
        return table.drop_columns(["_group"]).append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64())).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    pieces = docs.mapInArrow(cut, f"{schema}, _group bigint")
    # groups are packed one by one, so a task's memory is that of one, whatever the session's number of partitions
    pieces = pieces.repartition(min(MOST_TASKS, max(1, -(-groups // GROUPS_PER_TASK))), "_group")
    return pieces.groupBy("_group").applyInArrow(pack, f"{schema}, sequence_id bigint, offset bigint")
