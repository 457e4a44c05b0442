"""What partition functions over Arrow batches share: runs of equal keys, set intersections by matrix products, the best matches of sparse vectors."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """Returns freed memory to the system, as a worker serves many tasks and stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal numbers in `keys`, from batches that are sorted by them; a run may go over batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((own[1:] != own[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if last is not None and (own[a] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own[a]
    if held:
        yield pa.Table.from_batches(held)


def list_rows(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The rows of a list column of numbers."""
    out = []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        flat, at = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
        out += [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return out


def shared_counts(sets: list[np.ndarray], n_left: int) -> np.ndarray:
    """How many elements the first n_left sets share with the others (with all, if n_left is their number), by products of 0-1 matrices.

    The diagonal of a set with itself counts only what another set has too.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    _, code, many = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    common = many > 1  # an element of one set is shared by none
    rank = np.cumsum(common) - 1
    keep = common[code]
    row, code = row[keep], rank[code[keep]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    right = slice(0, None) if n_left == len(sets) else slice(n_left, None)
    out = np.zeros((n_left, len(sets) - (right.start or 0)), np.float32)
    width = 4096
    for at in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(code, [at, at + width])
        some = np.zeros((len(sets), width), np.float32)
        some[row[lo:hi], code[lo:hi] - at] = 1
        out += some[:n_left] @ some[right].T
    return out


def shared_pairs(left: list[np.ndarray], right: list[np.ndarray], most: int = 2_000_000, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, shared) of all pairs of left and right sets that share elements, in blocks.

    Elements meet one by one, up to `most` meetings at once. Where these are over 32 a pair or a set has more alone, matrix products take over.
    """
    if not left or not right:
        return
    n = len(right)
    l_size, r_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    _, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    l_code, r_code = code[: l_size.sum()], code[l_size.sum() :]
    order = np.argsort(r_code, kind="stable")
    r_row, r_code = np.repeat(np.arange(n), r_size)[order], r_code[order]
    begin = np.searchsorted(r_code, l_code)
    many = np.searchsorted(r_code, l_code, "right") - begin
    l_end = np.cumsum(l_size)
    met = np.r_[0, np.cumsum(many)]
    met_end = met[l_end]  # meetings of all sets up to each
    if met[-1] > 32 * len(left) * n or np.diff(met_end, prepend=0).max() > most:
        for a in range(0, len(left), block):
            for b in range(0, n, block):
                some, others = left[a : a + block], right[b : b + block]
                # an empty set last keeps the two sides apart where their numbers of sets agree
                shared = shared_counts([*some, *others, np.zeros(0, np.int64)], len(some))[:, :-1]
                i, j = np.nonzero(shared)
                yield i + a, j + b, shared[i, j].astype(np.int64)
        return
    first = 0
    while first < len(left):
        before = met_end[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(met_end, before + most, "right")))
        own = slice(int(l_end[first] - l_size[first]), int(l_end[last - 1]))
        k = many[own]
        place = np.repeat(begin[own] - (met[own] - before), k) + np.arange(met_end[last - 1] - before)
        row = np.repeat(np.repeat(np.arange(first, last), l_size[first:last]), k)
        pair, shared = np.unique(row * n + r_row[place], return_counts=True)
        if len(pair):
            yield pair // n, pair % n, shared
        first = last


class BestMatches:
    """The k rows with the highest products for each of some sparse queries, over all rows that are shown; ties go to the smaller key.

    Queries are (query number, term number, weight) arrays; terms are numbered from 0. Scores are rounded to `digits`, so that sums in
    another order are ties too. Memory is that of the queries and of one block of rows, whatever their number.
    """

    BLOCK = 200_000

    def __init__(self, queries: tuple[np.ndarray, np.ndarray, np.ndarray], n_queries: int, n_terms: int, k: int, digits: int):
        q, t, w = queries
        order = np.argsort(t, kind="stable")
        self.q, self.w = q[order], w[order]
        self.at = np.searchsorted(t[order], np.arange(n_terms + 1))
        self.n, self.k, self.digits = n_queries, k, digits
        self.best: list[list[tuple]] = [[] for _ in range(n_queries)]

    def show(self, keys: list, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, norms: np.ndarray) -> None:
        """Rows by keys, how many terms each has, and their terms and weights one after the other."""
        ends = np.cumsum(sizes)
        first, most = 0, max(1, 4_000_000 // max(1, self.n))
        while first < len(keys):  # blocks of rows with a bounded number of products
            begin = int(ends[first] - sizes[first])
            last = max(first + 1, min(first + most, int(np.searchsorted(ends, begin + self.BLOCK))))
            own = slice(begin, int(ends[last - 1]))
            self._show(keys[first:last], sizes[first:last], terms[own], weights[own], norms[first:last])
            first = last

    def _show(self, keys: list, sizes: np.ndarray, t: np.ndarray, w: np.ndarray, norms: np.ndarray) -> None:
        row = np.repeat(np.arange(len(keys)), sizes)
        dot, hit = np.zeros(len(keys) * self.n), np.zeros(len(keys) * self.n, bool)
        many = self.at[t + 1] - self.at[t]
        ends = np.cumsum(many)
        for a in range(0, len(t), 20_000):
            b = min(a + 20_000, len(t))
            own = many[a:b]
            place = np.repeat(self.at[t[a:b]] - (ends[a:b] - own), own) + np.arange(ends[a] - own[0], ends[b - 1])
            cell = np.repeat(row[a:b], own) * self.n + self.q[place]
            dot += np.bincount(cell, np.repeat(w[a:b], own) * self.w[place], len(dot)) if len(cell) > len(dot) // 8 else 0
            if len(cell) <= len(dot) // 8:
                np.add.at(dot, cell, np.repeat(w[a:b], own) * self.w[place])
            hit[cell] = True
        score = np.round(dot.reshape(len(keys), self.n) / norms[:, None], self.digits)
        hit = hit.reshape(len(keys), self.n)
        for q in range(self.n):
            rows = np.flatnonzero(hit[:, q])
            if not len(rows):
                continue
            own = score[rows, q]
            if len(rows) > self.k:
                least = np.partition(own, len(own) - self.k)[len(own) - self.k]
                if len(self.best[q]) == self.k:
                    least = max(least, -self.best[q][-1][0])
                rows, own = rows[own >= least], own[own >= least]
            both = self.best[q] + [(-s, keys[r]) for s, r in zip(own.tolist(), rows.tolist(), strict=True)]
            both.sort()
            self.best[q] = both[: self.k]

    def found(self) -> tuple[list[int], list, list[float]]:
        flat = [(q, key, -s) for q, own in enumerate(self.best) for s, key in own]
        return [x[0] for x in flat], [x[1] for x in flat], [x[2] for x in flat]
