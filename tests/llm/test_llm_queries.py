"""The opN_ queries on the smallest tables: against their SQL, or against plain Python over all rows."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_shards_simhash import brute_components, brute_fingerprint
from test_text_operators import PLAIN, brute_spans, brute_tree
from tokenizers import Tokenizer

from lodestone.llm import html_extract, quality, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    plain = lambda frame: (sorted(frame), sorted(map(str, frame[sorted(frame)].itertuples(index=False, name=None))))
    assert plain(queries.QUERIES[name](spark, SF).toPandas()) == plain(con.sql(queries.SQL[name]).df())


def encoded(name, end, docs):
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    return {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, end], "<u4") for i, t in docs}


def test_op1(spark, docs):
    ids, rows = encoded("byte_bpe_50k.json", 1, docs), queries.op1_packing(spark, SF).collect()
    pieces, used = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
    for own in (*pieces.values(), *used.values()):
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1].tolist()]
    assert all(sum(n for _, n in pieces[i]) == len(x) for i, x in ids.items()) and all(sum(n for _, n in own) <= 2048 for own in used.values())
    assert sum(map(len, ids.values())) > 0.95 * 2048 * len(used)


def test_op2(spark, docs):
    rows = {r.doc_id: r for r in queries.op2_pii(spark, SF).collect()}
    for i, t in docs:
        spans = brute_spans(t)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert set(filter(None, base.split(","))) <= set(rows[i].spans.split(","))


def test_op3(spark, docs):
    ids, at, want = encoded("word_bpe_49k.json", 2, docs), 0, []
    for i, _ in docs:
        want.append((i, at, len(ids[i]), zlib.crc32(ids[i].tobytes())))
        at += len(ids[i])
    assert sorted(tuple(r) for r in queries.op3_token_ids(spark, SF).collect()) == want


def spark_xxhash(values):
    """Spark's xxhash64 over a seed (int), a doc_id (long) and a shard (int), by its definition on 4 and 8 bytes."""
    m, p1, p2, p3, p4, p5 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    turn = lambda x, n: ((x << n) | (x >> (64 - n))) & m
    h = 42
    for value, wide in values:
        if wide:
            h = (h + p5 + 8) & m
            h ^= turn(((value & m) * p2) & m, 31) * p1 & m
            h = (turn(h, 27) * p1 + p4) & m
        else:
            h = (h + p5 + 4) & m
            h ^= ((value & 0xFFFFFFFF) * p1) & m
            h = (turn(h, 23) * p2 + p3) & m
        h ^= h >> 33
        h = h * p2 & m
        h ^= h >> 29
        h = h * p3 & m
        h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def test_op4(spark, docs):
    rows = {r.doc_id: r for r in queries.op4_sharding(spark, SF).collect()}
    slots = defaultdict(list)
    best = lambda i, n: max(range(n), key=lambda x: (spark_xxhash([(23, False), (i, True), (x, False)]), x))
    for i, t in docs:
        raw = (t or "").encode()
        assert (rows[i].size, rows[i].text_crc32, rows[i].law, rows[i].shard, rows[i].grown_shard) == (len(raw) + 16, zlib.crc32(raw), "key", best(i, 40), best(i, 41))
        assert rows[i].grown_shard in (rows[i].shard, 40)
        slots[rows[i].shard].append(rows[i].slot)
    assert len(rows) == len(docs) and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_op5(spark, docs):
    prints = [brute_fingerprint(t) for _, t in docs]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(docs, prints, brute_components([i for i, _ in docs], prints), strict=True)]
    assert sorted(tuple(r) for r in queries.op5_simhash(spark, SF).collect()) == want


def test_op6(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    model = html_extract.trained()
    for r in queries.op6_main_text(spark, SF).collect():
        assert r.text == html_extract.main_text(pages[r.page_id].html or "", model) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        blocks = r.text.split("\n\n")
        assert blocks == [" ".join(b.split()) for b in blocks]
        article = re.search(r"<article\b.*?</article>", pages[r.page_id].html or "", re.S)
        if article:
            seen = " ".join("".join(n.text) for n in html_extract.parse(article[0]) if n.tag == "#run").split()
            assert not Counter(r.text.split()) - Counter(seen)


def test_op9(spark, docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    some = [d for d in docs if len(d[1] or "") < 3000][:60]
    train = [t for i, t in docs if not held(i)]
    rows = {r.doc_id: r for r in queries.op9_lm_scores(spark, SF).collect()}
    want, _, _ = brute_tree([t for _, t in some], train)
    assert all(abs(rows[i].score - w) < 1e-6 * max(1, abs(w)) for (i, _), w in zip(some, want, strict=True))
    words = lambda t: (t or "").encode().lower().split()
    counts = Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    rate = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    for i, t in docs:
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + 1, n)
        assert abs(r.base_score - sum(rate(counts[w]) for w in words(t)) - rate(len(train))) < 1e-6 * max(1, abs(r.base_score))


def test_op10(spark, docs):
    """The scores are the softmax of the documents' means, one feature after the other; held-out labels are met."""
    rows = {r.doc_id: r for r in queries.op10_quality(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    value, bias = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    import pyarrow as pa

    for i, t in docs[:80]:
        own = quality.Texts(pa.array([t]))
        code, sizes = quality.word_features(own.names)
        f, w = own.document_features(0, code, sizes)
        assert abs(rows[i].score - 1 / (1 + math.exp(-float(value[f] @ w) - bias))) < 1e-4
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.values())
    held = [i for i in labels if i in rows and rows[i].held_out]
    assert sum(rows[i].predicted == labels[i] for i in held) >= 0.85 * len(held)
