"""Quality classifier: supervised subword embeddings.

A word's features are the hashes of the word, of its character n-grams (lengths GRAMS, with marks for its ends) and of its shape
(runs of upper case, lower case, digits, other letters and signs), and a mark if it repeats the word before it or stands in a line
that the text had before. Each feature has a learned vector; a word is the mean of its features' vectors, a document the mean of
its words; a softmax over two classes gives the score. Vectors and output are trained together by stochastic gradient descent in
numpy, on a bounded sample: the TRAIN_ROWS labelled rows with the smallest seeded hashes of their doc_ids. Nothing but the text is
an input. As the output is linear in the mean, scoring needs one number for each feature, which is what is broadcast (BUCKETS
numbers, whatever the corpus).

Labels come only from rows whose crc32 of the doc_id as text isn't 0 modulo FOLDS; null labels and null doc_ids are not used; repeated
labels count once each. Null text is empty; an empty text has a feature of its own. With no label or with labels of one class only
the score is that class's smoothed share. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, give_back

BUCKETS, DIMENSIONS, GRAMS, FOLDS, TRAIN_ROWS, EPOCHS, RATE, CUT = 1 << 18, 8, (3, 4), 5, 4000, 12, 1.0, 0.3
_KIND = np.array([4 if c < 48 else 2 if c < 58 else 4 if c < 65 else 0 if c < 91 else 4 if c < 97 else 1 if c < 123 else 4 if c < 128 else 3 for c in range(256)], np.uint8)


def _hash(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(40)).astype(np.int64) % (BUCKETS - 16) + 16


#: The first numbers are features of their own.
AGAIN, SAME_LINE, NOTHING = 1, 2, 3
#: Bytes of words whose features are made at once, about; each takes some 150 bytes of memory meanwhile.
BLOCK = 100_000


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word (a large_binary array), one after the other, and how many each has."""
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2)
    cuts = np.flatnonzero(np.diff(ends // BLOCK)) + 1
    found = [_block_features(words.slice(a, b - a)) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)], strict=True)]
    return np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found])


def _block_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
    # each word between a 2 and a 3, which no word holds
    starts = np.cumsum(sizes + 2) - sizes - 2
    own = np.full(len(raw) + 2 * len(sizes), 2, np.uint8)
    place = np.arange(len(raw)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
    own[place] = raw
    own[starts + sizes + 1] = 3
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    codes, wide = [], own.astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(own) < n:
                continue
            key = np.zeros(len(own) - n + 1, np.uint64)
            for j in range(n):
                key = key << np.uint64(8) | wide[j : len(own) - n + 1 + j]
            inside = np.flatnonzero(word[: len(key)] == word[n - 1 :])
            codes.append((word[inside], _hash(key[inside], n)))
        power = np.cumprod(np.full(int(sizes.max(initial=0)) + 2, 0x100000001B3, np.uint64))
        offset = np.arange(len(own)) - np.repeat(starts, sizes + 2)
        whole = np.add.reduceat((wide + np.uint64(1)) * power[offset], starts) if len(starts) else np.zeros(0, np.uint64)
        codes.append((np.arange(len(sizes)), _hash(whole, 1)))
        kind = _KIND[own].astype(np.uint64)
        first = np.r_[True, (kind[1:] != kind[:-1]) | (word[1:] != word[:-1])]
        at, w = np.flatnonzero(first), word[first]
        opens = np.searchsorted(w, np.arange(len(sizes)))  # each word's first run
        rank = np.arange(len(at)) - opens[w]
        powers = np.cumprod(np.r_[np.uint64(1), np.full(int(rank.max(initial=0)), 0x100000001B3, np.uint64)])
        shape = np.add.reduceat((kind[at] + np.uint64(1)) * powers[rank], opens) if len(sizes) else np.zeros(0, np.uint64)
        codes.append((np.arange(len(sizes)), _hash(shape, 0)))
    word, code = np.concatenate([w for w, _ in codes]), np.concatenate([c for _, c in codes])
    order = np.argsort(word, kind="stable")
    return code[order].astype(np.int32), np.bincount(word, minlength=len(sizes))


_SPACE = [b"\t", b"\r", b"\x0b", b"\x0c", b"\x02", b"\x03"]


class Texts:
    """Distinct words of some texts, and each text's words as numbers of those, with marks for repeats."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
        for x in _SPACE:
            texts = pc.replace_substring(texts, x, b" ")
        lines = pc.split_pattern(texts, b"\n")
        line_at, lines = lines.offsets.to_numpy(), lines.values
        doc_of_line = np.repeat(np.arange(len(texts)), np.diff(line_at))
        line = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
        key = doc_of_line * np.int64(max(1, len(lines))) + line
        once = np.zeros(len(lines), bool)
        once[np.unique(key, return_index=True)[1]] = True
        words = pc.split_pattern(lines, b" ")
        word_at, coded = words.offsets.to_numpy(), words.values.dictionary_encode()
        codes, empty = coded.indices.to_numpy(), coded.dictionary.index(pa.scalar(b"", pa.large_binary())).as_py()
        of_line = np.repeat(np.arange(len(lines)), np.diff(word_at))
        real = codes != empty
        self.codes, of_line = codes[real], of_line[real]
        self.doc = doc_of_line[of_line]
        self.n = np.bincount(self.doc, minlength=len(texts))
        self.names = coded.dictionary
        self.again = np.r_[False, (self.codes[1:] == self.codes[:-1]) & (self.doc[1:] == self.doc[:-1])] if len(self.codes) else np.zeros(0, bool)
        self.old = ~once[of_line]

    def document_features(self, i: int, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features of text i and their weights, which sum to 1."""
        own = np.flatnonzero(self.doc == i)
        if not len(own):
            return np.array([NOTHING]), np.ones(1)
        starts = np.cumsum(sizes) - sizes
        w, many = self.codes[own], sizes[self.codes[own]]
        share = 1 / (many + self.again[own] + self.old[own])
        at = np.repeat(starts[w] - np.cumsum(many) + many, many) + np.arange(many.sum())
        f = np.r_[code[at], np.full(self.again[own].sum(), AGAIN), np.full(self.old[own].sum(), SAME_LINE)]
        v = np.r_[np.repeat(share, many), share[self.again[own]], share[self.old[own]]] / len(own)
        f, inverse = np.unique(f, return_inverse=True)
        return f, np.bincount(inverse, v)

    def scores(self, value: np.ndarray, bias: float) -> np.ndarray:
        code, sizes = word_features(self.names)
        total = np.add.reduceat(value[code], np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)
        w, marks = self.codes, self.again.astype(np.int64) + self.old
        own = (total[w] + self.again * value[AGAIN] + self.old * value[SAME_LINE]) / (sizes[w] + marks)
        mean = np.bincount(self.doc, own, len(self.n)) / np.maximum(self.n, 1)
        return 1 / (1 + np.exp(-np.where(self.n > 0, mean, value[NOTHING]) - bias))


def train(features: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray, *, seed: int = 5) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over one document at a time; returns each feature's share of the logit, and the bias."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIMENSIONS)) - 0.5) * 2 / DIMENSIONS).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    weights = [w.astype(np.float32, copy=False) for w in weights]
    steps, step = EPOCHS * len(labels), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)).tolist():
            rate = RATE * (1 - step / steps)
            step += 1
            f, w = features[i], weights[i]
            own = vectors[f]
            mean = w @ own
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # the step of fastText's averaged input: each feature moves by the whole gradient, weighed by its part in the mean
            vectors[f] = own - rate * np.sqrt(w)[:, None] * back
    value = vectors @ (out[:, 1] - out[:, 0])
    return value.astype(np.float32), float(bias[1] - bias[0])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, the trained model, from all rows of one partition."""
    seen = []
    for batch in batches:
        for rows in byte_slices(batch, "text", 1_000_000):
            own = Texts(rows.column("text"))
            code, sizes = word_features(own.names)
            ranks, labels = rows.column("_rank").to_pylist(), rows.column("label").to_pylist()
            for i in range(rows.num_rows):
                f, w = own.document_features(i, code, sizes)
                seen.append((ranks[i], labels[i], f.astype(np.int32), w.astype(np.float32)))
    if seen:
        seen.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))  # the rows' order decides the order of training
        value, bias = train([x[2] for x in seen], [x[3] for x in seen], np.array([x[1] for x in seen]))
        seen.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["value", "bias"])


def _score(batches: Iterator[pa.RecordBatch], model: Broadcast, folds: int) -> Iterator[pa.RecordBatch]:
    value, bias = model.value
    for batch in batches:
        for rows in byte_slices(batch, "text", 1_000_000):
            out = [x is not None and zlib.crc32(str(x).encode()) % folds == 0 for x in rows.column("doc_id").to_pylist()]
            scores = Texts(rows.column("text")).scores(value, bias)
            added = [pa.array(out, pa.bool_()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, "_held_out", "_score"])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = FOLDS, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Trains on at most `rows` labelled documents in one task; only the model comes to the driver."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0))
    usable = usable.select("doc_id", (F.col(label) == 1).cast("int").alias("label"), F.xxhash64(F.lit(11), "doc_id").alias("_rank"))
    chosen = F.broadcast(usable.orderBy("_rank", "doc_id", "label").limit(rows))
    found = docs.select("doc_id", "text").join(chosen, "doc_id").orderBy("_rank", "text").limit(rows)
    got = found.select("_rank", "label", "text").coalesce(1).mapInArrow(_train, "value binary, bias double").collect()
    if not got:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(got[0].value, np.float32), got[0].bias


def score_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = FOLDS, rows: int = TRAIN_ROWS) -> DataFrame:
    """All of docs' columns (save `_held_out` and `_score`, which are replaced), with _held_out and _score."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label=label, folds=folds, rows=rows))
    docs = docs.drop("_held_out", "_score")
    schema = docs.withColumns({"_held_out": F.lit(True), "_score": F.lit(0.0)}).schema
    return docs.mapInArrow(partial(_score, model=model, folds=folds), schema)
