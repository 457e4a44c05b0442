"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of ASCII letters and digits and of all non-ASCII characters. In each window of SPAN words the smallest
of its GRAM-word hashes is kept (the last of equals), in documents and items alike, so a shared run of SPAN words keeps the same
fingerprint in both. A kept fingerprint is one row, with the words of the windows that kept it (15 at most). Fingerprints of documents
are joined with those of the benchmark, and each hit is extended word by word to both sides of its gram; SPAN equal words or more are a
hit, and all words of the extended span are hit. An item of fewer words than SPAN is one window; its fingerprint is the hash of all its
words, and its hits are compared word by word.

A bit table of fixed size (TABLE_BITS bits, whatever the benchmark's size) holds the fingerprints of the benchmark, so that
documents send only probable hits to the join; the join and the extension decide. Items that share a fingerprint's words share its
row there.

Null text has no words. Empty items match nothing. Repeated documents come back once each, repeated items count once.
An empty benchmark leaves all documents clean. Texts are known by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, byte_slices, materialize

SPAN, GRAM, TABLE_BITS = 10, 5, 24
#: Words of a document that are looked at in one go; neighbouring runs overlap by SPAN - 1 words.
RUN_WORDS = 200_000
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, 1 << 20), base, np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x)
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of one run of words, and hashes of any neighbours among them."""

    def __init__(self, words: list[bytes]):
        self.words = words
        joined = np.frombuffer(b" ".join(words), np.uint8)
        up, self.down = _powers(len(joined) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum((joined + np.uint64(1)) * up[: len(joined)])]
        space = np.flatnonzero(joined == 32)
        self.starts, self.ends = np.r_[0, space + 1], np.r_[space, len(joined)]

    def grams(self, k: int) -> np.ndarray:
        """Hashes of k neighbouring words, by the first one's place."""
        a, b = self.starts[: len(self.starts) - k + 1], self.ends[k - 1 :]
        return _mix((self.sums[b] - self.sums[a]) * self.down[a])

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints that windows of SPAN words keep: their hashes, the places of their grams, and their first and last windows."""
        own = self.grams(GRAM)
        views = np.lib.stride_tricks.sliding_window_view(own, SPAN - GRAM + 1)
        at = SPAN - GRAM - views[:, ::-1].argmin(1) + np.arange(len(views))
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        return own[at[first]], at[first], first, last

    def rows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for items of n words: with fewer than SPAN, each run of n words is a fingerprint of its own."""
        if n == SPAN:
            return self.kept()
        hashes = self.grams(n)
        place = np.arange(len(hashes))
        return hashes, place, place, place


def _entry(own: Words, n: int, place: int, first: int, last: int) -> tuple[int, str]:
    """How many words stand before the gram, and the words of the windows."""
    return place - first, b" ".join(own.words[first : last + n]).decode("utf-8", "replace")


def _fingerprints(items: DataFrame, item: str) -> DataFrame:
    """(item, n, fp, before, words): the kept fingerprints of each item."""
    items = items.select(F.col(item).cast("string").alias("item"), "text")
    names = ["item", "n", "fp", "before", "words"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_ in byte_slices(batch, "text"):
                for name, text in zip(slice_.column("item").to_pylist(), as_bytes(slice_.column("text")), strict=True):
                    words = split_words(text)
                    for part in range(0, len(words), RUN_WORDS - SPAN + 1):
                        if part and len(words) - part < SPAN:
                            break
                        own = Words(words[part : part + RUN_WORDS])
                        n = min(SPAN, len(words))
                        fp, place, first, last = own.rows(n)
                        entries = [_entry(own, n, *x) for x in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)]
                        cols = [[name] * len(fp), [n] * len(fp), fp.view(np.int64), [e[0] for e in entries], [e[1] for e in entries]]
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names=names)

    return items.mapInArrow(run, "item string, n int, fp bigint, before int, words string")


def _bit_table(prints: DataFrame) -> tuple[np.ndarray, list[int]]:
    """One bit for each place that a fingerprint falls on, and the lengths of short items."""
    place = F.shiftrightunsigned("fp", 64 - TABLE_BITS).alias("p")
    words = prints.select(place).groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)  # at most 2**18 rows of two numbers come to the driver
    rows = words.toPandas()
    table[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)
    short = [r.n for r in prints.where(F.col("n") < SPAN).select("n").distinct().collect()]  # fewer than SPAN
    return table, short


def _has(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = x >> np.uint64(64 - TABLE_BITS)
    return (table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def probable_hits(words: list[bytes], table: np.ndarray, short: list[int]) -> list[dict]:
    """Kept fingerprints of a document that the bit table doesn't rule out; `gram` is the place of the gram's first word."""
    out = []
    for first_word in range(0, max(1, len(words)), RUN_WORDS - SPAN + 1):
        part = words[first_word : first_word + RUN_WORDS]
        if not part:
            break
        own = Words(part)
        for n in [*short, SPAN]:
            if len(part) < n:
                continue
            fp, place, first, last = own.rows(n)
            seen = np.flatnonzero(_has(table, fp))
            hashes = fp.view(np.int64)
            for i in seen.tolist():
                before, text = _entry(own, n, int(place[i]), int(first[i]), int(last[i]))
                out.append({"gram": first_word + int(place[i]), "n": n, "fp": int(hashes[i]), "before": before, "words": text})
        if first_word + RUN_WORDS >= len(words):
            break
    return out


_HITS = pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int32()), ("fp", pa.int64()), ("before", pa.int32()), ("words", pa.string())]))


def _equal_run(steps: Column, mine: Column, theirs: Column, sign: int, at: Column, other: Column) -> Column:
    """How many words are equal, one after the other, from a place on to one side."""
    zero = F.struct(F.lit(True).alias("go"), F.lit(0).alias("n"))

    def step(a: Column, i: Column) -> Column:
        same = a["go"] & (F.get(mine, at + sign * i) == F.get(theirs, other + sign * i))
        return F.struct(F.coalesce(same, F.lit(False)).alias("go"), (a["n"] + F.when(same, 1).otherwise(0)).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), steps), zero, step, lambda a: a["n"])


def extended(joined: DataFrame) -> DataFrame:
    """(row, start, stop, set) of the hits that extend to SPAN words (n for short items), from hits joined with the benchmark's fingerprints."""
    size = F.when(F.col("n") < SPAN, F.col("n")).otherwise(GRAM)
    mine, theirs = F.split("words", " "), F.split("b_words", " ")
    rows = joined.withColumns({"d": mine, "b": theirs, "g": size})
    gram = F.slice("d", F.col("before") + 1, F.col("g")) == F.slice("b", F.col("b_before") + 1, F.col("g"))
    rows = rows.where(gram)
    most_left = F.least("before", "b_before")
    most_right = F.least(F.size("d") - F.col("before") - F.col("g"), F.size("b") - F.col("b_before") - F.col("g"))
    none = F.lit(0)
    left = F.when(most_left > 0, _equal_run(most_left, F.col("d"), F.col("b"), -1, F.col("before"), F.col("b_before"))).otherwise(none)
    end, b_end = F.col("before") + F.col("g") - 1, F.col("b_before") + F.col("g") - 1
    right = F.when(most_right > 0, _equal_run(most_right, F.col("d"), F.col("b"), 1, end, b_end)).otherwise(none)
    rows = rows.withColumns({"l": left, "r": right}).where(F.col("l") + F.col("g") + F.col("r") >= F.col("n"))
    return rows.select("_row", (F.col("gram") - F.col("l")).alias("start"), (F.col("gram") + F.col("g") + F.col("r")).alias("stop"), "set")


def _scan(batches: Iterator[pa.RecordBatch], table: np.ndarray, short: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in byte_slices(batch, "text"):
            n_words, hits = [], []
            for text in as_bytes(rows.column("text")):
                words = split_words(text)
                n_words.append(len(words))
                hits.append(probable_hits(words, table, short))
            cols = [rows.column("_row"), rows.column("doc_id"), rows.column("text_key"), pa.array(n_words, pa.int64()), pa.array(hits, _HITS)]
            yield pa.RecordBatch.from_arrays(cols, names=["_row", "doc_id", "text_key", "n_words", "hits"])


def contamination(docs: DataFrame, benchmark: DataFrame, *, item: str = "item_id") -> DataFrame:
    """One row for each document: doc_id, text_key (the text's SHA-256), n_words, n_hit, n_items, items (sorted as strings), contaminated."""
    prints = materialize(_fingerprints(benchmark, item), "item-prints")
    # fingerprints with the same words share a row, and those of the same items a list of items
    shared = prints.groupBy("n", "fp", "before", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    shared = materialize(shared.withColumn("set", F.sha2(F.to_json("items"), 256)), "print-items")
    table, short = _bit_table(prints)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    numbered = docs.select("doc_id", "text", key.alias("text_key")).withColumn("_row", F.monotonically_increasing_id())
    seen = numbered.mapInArrow(
        partial(_scan, table=table, short=short),
        f"_row bigint, doc_id {id_type}, text_key binary, n_words bigint, hits array<struct<gram:bigint,n:int,fp:bigint,before:int,words:string>>",
    )
    seen = materialize(seen, "contamination")
    hits = seen.select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    known = shared.select("n", "fp", F.col("before").alias("b_before"), F.col("words").alias("b_words"), "set")
    hits = extended(hits.join(known, ["n", "fp"]))
    covered = hits.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("s"), F.collect_set("set").alias("sets"))
    zero = F.lit(0).cast("bigint")
    union = F.aggregate(
        "s", F.struct(zero.alias("n"), zero.alias("to")),
        lambda a, x: F.struct((a["n"] + F.greatest(zero, x["stop"] - F.greatest(a["to"], x["start"]))).alias("n"), F.greatest(a["to"], x["stop"]).alias("to")),
        lambda a: a["n"],
    )
    covered = materialize(covered.select("_row", union.alias("n_hit"), "sets"), "covered")
    members = shared.groupBy("set").agg(F.first("items").alias("items"))
    named = covered.select("_row", F.explode("sets").alias("set")).join(members, "set").groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    out = seen.select("_row", "doc_id", "text_key", "n_words").join(covered.select("_row", "n_hit"), "_row", "left").join(named, "_row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", zero)
    return out.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, item: str = "item_id") -> DataFrame:
    """Documents without any of the benchmark's windows, with all their columns, whatever they are called."""
    bad = contamination(docs, benchmark, item=item).where("contaminated").select(F.col("text_key").alias("bad_key")).distinct()
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key"))
    return keyed.join(bad, keyed["key"] == bad["bad_key"], "left_anti").select("doc.*")
