"""Language-model scores by a probabilistic suffix tree, beside a smoothed unigram baseline.

A text is lower-cased (A-Z) and cut into words at white space. The model's symbols are the bytes of the words joined by single
spaces, then one end symbol. Contexts are the last 0 to DEPTH bytes (DEPTH, the order of the tree, is a parameter, 7 at most); bytes
before a text's start read as end symbols. A context is retained if it stands LEAST times or more in the training texts, whatever
their size, and the divergence of its next-symbol distribution from its parent's (the context without its first byte) is at least
DIVERGENCE bits, or if a longer retained context ends in it. So the tree grows with the corpus. A retained context's distribution is
(counts + ALPHA times its parent's distribution) / (all + ALPHA); the root's parent is uniform over bytes. The longest retained suffix
is the state that predicts the next byte. Nothing is rounded off: all counts enter, and every gram of the corpus gets its probability.

The tree is a set of tables, one for each length, made level by level by joins on the context and on its suffix; a context has at
most 256 symbols, so no key is hot. Only scores of frequent grams and counts of frequent words are broadcast, at most COMMON rows each
(the frequency they need is found by a histogram); all others are joined, and by their choice none has a large part of the rows.

Counts cover all training documents (held out: crc32 of the doc_id as text is 0 modulo FOLDS; a null doc_id is never held out). Words
are counted by a 64-bit hash. Null text is empty; an empty text has its end token. Repeated rows are scored once each and counted each
time. With no training document the tree is uniform over bytes and no token is known. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, byte_slices, materialize

DEPTH, LEAST, DIVERGENCE, ALPHA, FOLDS, COMMON = 5, 4, 0.02, 8.0, 10, 700_000
#: Counts that a task holds.
HELD = 1_000_000
END = 10  # a byte that no word holds


def held_out(doc_ids: list, folds: int = FOLDS) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % folds == 0 for x in doc_ids], bool)


class Slice:
    """The words and the symbols of some texts."""

    def __init__(self, texts: list[bytes], depth: int = DEPTH):
        words = [x.lower().split() for x in texts]
        self.n_words = np.fromiter(map(len, words), np.int64, len(words))
        coded = pa.array([w for x in words for w in x], pa.large_binary()).dictionary_encode()
        self.codes = coded.indices.to_numpy()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        self.hashes = pd.util.hash_array(names.astype(object), categorize=False).view(np.int64) if len(names) else np.zeros(0, np.int64)
        pad, end = bytes([END]) * depth, bytes([END])
        streams = [pad + b" ".join(x) + end for x in words]
        self.n_symbols = np.fromiter(map(len, streams), np.int64, len(streams)) - depth
        symbols = np.frombuffer(b"".join(streams), np.uint8)
        keys = np.zeros(max(0, len(symbols) - depth), np.uint64)
        for j in range(depth + 1):
            keys <<= np.uint64(8)
            keys |= symbols[j : len(symbols) - depth + j]
        # the padding of all texts but the first is predicted by no one
        skip = np.cumsum(self.n_symbols + depth)[:-1, None] - np.arange(depth, 0, -1)
        self.grams = np.delete(keys, skip.ravel())


def _combined(kinds: list[np.ndarray], keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Sums of equal kinds and keys."""
    out: tuple[list, list, list] = ([], [], [])
    kind, key, count = np.concatenate(kinds), np.concatenate(keys), np.concatenate(n)
    for k in (0, 1, 2):
        own = kind == k
        names, code = np.unique(key[own], return_inverse=True)
        sums = np.zeros(len(names), np.int64)
        np.add.at(sums, code, count[own])
        for to, x in zip(out, (np.full(len(names), k, np.int8), names, sums), strict=True):
            to.append(x)
    return out


def _count(batches: Iterator[pa.RecordBatch], depth: int, folds: int) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): kind 0 words, 1 end tokens, 2 symbols with their longest context; those of held-out texts too, with n 0.

    A task adds up what it has counted whenever that is HELD rows, and gives it out if it stays above half of that.
    """
    found: tuple[list, list, list] = ([], [], [])

    def rows() -> Iterator[pa.RecordBatch]:
        kinds, keys, n = (np.concatenate(x) for x in found)
        for i in range(0, len(keys), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in (kinds, keys, n)], names=["kind", "key", "n"])

    for batch in batches:
        for part in byte_slices(batch, "text", 3_000_000):
            held = held_out(part.column("doc_id").to_pylist(), folds).tolist()
            every = as_bytes(part.column("text"))
            own = Slice([x for x, h in zip(every, held, strict=True) if not h], depth)
            grams, n = np.unique(own.grams, return_counts=True)
            other = np.setdiff1d(Slice([x for x, h in zip(every, held, strict=True) if h], depth).grams, grams)
            found[0].append(np.r_[np.zeros(len(own.hashes), np.int8), np.int8(1), np.full(len(grams) + len(other), 2, np.int8)])
            found[1].append(np.r_[own.hashes, 0, grams.view(np.int64), other.view(np.int64)])
            found[2].append(np.r_[np.bincount(own.codes, minlength=len(own.hashes)), held.count(False), n, np.zeros(len(other))].astype(np.int64))
            if sum(map(len, found[1])) > HELD:
                found = _combined(*found)
                if sum(map(len, found[1])) > HELD // 2:
                    yield from rows()
                    found = ([], [], [])
    if found[0]:
        found = _combined(*found)
        yield from rows()


def _low(key: Column, size: int) -> Column:
    """The last `size` bytes of a key."""
    return key.bitwiseAND(F.lit((1 << 8 * size) - 1)) if size < 8 else key


def gram_scores(counts: DataFrame, depth: int, least: int, divergence: float, alpha: float) -> DataFrame:
    """(key, n, score): log10 probability of the last byte of each gram of depth + 1 bytes after the bytes before it, from (key, n)."""
    grams = {depth: counts}
    for k in range(depth - 1, -1, -1):
        grams[k] = materialize(grams[k + 1].groupBy(_low(F.col("key"), k + 1).alias("key")).agg(F.sum("n").alias("n")), "lm-grams")
    levels, tests = {}, {}
    context = F.shiftrightunsigned("key", 8)
    for k in range(depth + 1):
        own = grams[k].withColumn("ctx", context if k else F.lit(0).cast("bigint"))
        own = own.withColumn("total", F.sum("n").over(Window.partitionBy("ctx")))
        if k == 0:
            levels[0] = materialize(own, "lm-level")
            continue
        parent = levels[k - 1].select(F.col("key").alias("up"), F.col("n").alias("up_n"), F.col("total").alias("up_total"))
        levels[k] = materialize(own.withColumn("up", _low(F.col("key"), k)).join(parent, "up").select("key", "up", "ctx", "n", "total", "up_n", "up_total"), "lm-level")
        share = F.col("n") / F.col("total")
        gain = F.sum(F.when(F.col("n") > 0, share * F.log2(share / (F.col("up_n") / F.col("up_total")))))
        passed = levels[k].where(F.col("total") >= least).groupBy("ctx").agg(gain.alias("gain")).where(F.col("gain") >= divergence)
        tests[k] = passed.select("ctx")
    kept = {}
    for k in range(depth, 0, -1):
        # what longer contexts end in is retained with them
        both = tests[k] if k == depth else tests[k].unionByName(kept[k + 1].select(_low(F.col("ctx"), k).alias("ctx")))
        kept[k] = materialize(both.distinct(), "lm-kept")
    p = materialize(levels[0].select("key", "n", ((F.col("n") + alpha / 256) / (F.col("total") + alpha)).alias("p")), "lm-p")
    for k in range(1, depth + 1):
        rows = levels[k].join(p.select(F.col("key").alias("up"), F.col("p").alias("up_p")), "up").join(kept[k].withColumn("kept", F.lit(True)), "ctx", "left")
        own = (F.col("n") + alpha * F.col("up_p")) / (F.col("total") + alpha)
        p = materialize(rows.select("key", "n", F.when(F.col("kept"), own).otherwise(F.col("up_p")).alias("p")), "lm-p")
    return p.select("key", "n", F.log10("p").alias("score"))


def frequent(rows: DataFrame, most: int) -> DataFrame:
    """The rows whose n is at least the least that at most `most` rows have; a row's n is at least 1."""
    step = F.floor(F.log2("n") * 16).cast("int")
    found = sorted(((r.step, r.rows) for r in rows.where("n > 0").groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()), reverse=True)  # some 1000 rows at most
    total, least = 0, None
    for at, n in found:
        total += n
        if total > most:
            break
        least = at
    return rows.where(F.lit(False)) if least is None else rows.where("n > 0").where(step >= least)


def _sorted(rows: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, with their values."""
    found = rows.select("key", value).toArrow()
    keys, values = found.column("key").to_numpy(), found.column(value).to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _lookup(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted names, and whether they are there."""
    if not len(names):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


def _rare(row: np.ndarray, doc: np.ndarray, codes: np.ndarray, keys: np.ndarray, kind: int) -> pa.RecordBatch | None:
    """(row, kind, key, tf) of what isn't broadcast."""
    if not len(doc):
        return None
    pair, tf = np.unique(doc * np.int64(len(keys)) + codes, return_counts=True)
    cols = [pa.array(row[pair // len(keys)]), pa.array(np.full(len(pair), kind, np.int8)), pa.array(keys[pair % len(keys)]), pa.array(tf.astype(np.int32))]
    return pa.RecordBatch.from_arrays([*cols, *[pa.nulls(len(pair), t) for t in _REST]], names=_NAMES)


def _score(batches: Iterator[pa.RecordBatch], sent: Broadcast, totals: tuple, depth: int, folds: int) -> Iterator[pa.RecordBatch]:
    """A head row for each text (kind -1) and a row for each of its words (kind 0) and grams (kind 2) that isn't broadcast."""
    (names, counts, grams, scores), (n_all, v, ends) = sent.value, totals
    log_all = np.log10(n_all + 0.1 * (v + 1))
    for batch in batches:
        for rows in byte_slices(batch, "text", 2_500_000):
            own = Slice(as_bytes(rows.column("text")), depth)
            doc = np.repeat(np.arange(rows.num_rows), own.n_words)
            at, known = _lookup(names, own.hashes)
            value = np.where(known, np.log10((counts[at] if len(names) else 0) + 0.1) - log_all, 0)
            codes, distinct = pd.factorize(own.grams)
            distinct = distinct.view(np.int64)
            symbols = np.repeat(np.arange(rows.num_rows), own.n_symbols)
            at, scored = _lookup(grams, distinct)
            gram_value = np.where(scored, scores[at] if len(grams) else 0, 0)
            score = np.bincount(symbols, gram_value[codes], rows.num_rows)
            base = np.bincount(doc, value[own.codes], rows.num_rows) + np.log10(ends + 0.1) - log_all
            n_known = np.bincount(doc, known[own.codes], rows.num_rows).astype(np.int64) + (ends > 0)
            row = rows.column("_row").to_numpy()
            out = held_out(rows.column("doc_id").to_pylist(), folds)
            heads = [pa.array(row), pa.array(np.full(len(row), -1, np.int8)), pa.array(np.zeros(len(row), np.int64)), pa.array(np.ones(len(row), np.int32))]
            rest = [pa.array(out), pa.array(own.n_words + 1), pa.array(n_known), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*heads, *rest, rows.column("doc_id")], names=[*_NAMES, "doc_id"])
            words, others = np.flatnonzero(~known[own.codes]), np.flatnonzero(~scored[codes])
            for whole in (_rare(row, doc[words], own.codes[words], own.hashes, 0), _rare(row, symbols[others], codes[others], distinct, 2)):
                for i in range(0, 0 if whole is None else whole.num_rows, 50_000):
                    part = whole.slice(i, 50_000)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, rows.schema.field("doc_id").type)], names=[*_NAMES, "doc_id"])


_NAMES = ["_row", "kind", "key", "tf", "held_out", "n_tokens", "n_known", "base", "score"]
_REST = [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def score_texts(docs: DataFrame, *, depth: int = DEPTH, least: int = LEAST, divergence: float = DIVERGENCE, alpha: float = ALPHA, folds: int = FOLDS, common: int = COMMON) -> DataFrame:
    """One row for each text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if not 1 <= depth <= 7:
        raise ValueError(f"depth must be 1 to 7, not {depth}")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = docs.mapInArrow(partial(_count, depth=depth, folds=folds), "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "lm-counts")
    sums = {r.kind: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    ends = sums[1].n if 1 in sums else 0
    n_all = ends + (sums[0].n if 0 in sums else 0)
    v = (ends > 0) + (sums[0].v if 0 in sums else 0)

    words = counts.where("kind = 0").select("key", "n")
    grams = gram_scores(counts.where("kind = 2").select("key", "n"), depth, least, divergence, alpha)
    sent = spark.sparkContext.broadcast((*_sorted(frequent(words, common), "n"), *_sorted(frequent(grams, common), "score")))  # at most `common` rows each

    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    schema = f"_row bigint, kind tinyint, key bigint, tf int, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, doc_id {id_type}"
    rows = numbered.mapInArrow(partial(_score, sent=sent, totals=(n_all, int(v), ends), depth=depth, folds=folds), schema)
    rows = materialize(rows, "lm-rows")  # the rows' numbers hold from here on
    log_all = float(np.log10(n_all + 0.1 * (v + 1)))
    values = words.select(F.lit(0).cast("tinyint").alias("kind"), "key", (F.log10(F.col("n") + 0.1) - log_all).alias("value"), (F.col("n") > 0).alias("seen"))
    values = values.unionByName(grams.select(F.lit(2).cast("tinyint").alias("kind"), "key", F.col("score").alias("value"), F.lit(False).alias("seen")))
    rare = rows.where("kind >= 0").select("_row", "kind", "key", "tf").join(values, ["kind", "key"], "left")
    unknown = F.coalesce("value", F.lit(float(np.log10(0.1)) - log_all))
    rare = rare.select("_row", F.when(F.col("seen"), F.col("tf")).otherwise(0).cast("bigint").alias("n_known"), F.when(F.col("kind") == 0, F.col("tf") * unknown).otherwise(0.0).alias("base"), F.when(F.col("kind") == 2, F.col("tf") * F.col("value")).otherwise(0.0).alias("score"))
    heads = rows.where("kind < 0").drop("kind", "key", "tf")
    both = heads.unionByName(rare, allowMissingColumns=True)
    out = both.groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(n_all).cast("bigint").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    )
    return out.drop("_row")
