import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from conftest import make_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestone.llm import bitpack, packing
from lodestone.llm.tokens import PieceEncoder


def plain(name):
    """The tokenizer as its file has it."""
    return Tokenizer.from_file(public_tokenizers.path(name))


def spark_hash(text):
    """Spark's xxhash64 of a string."""
    return 42 if text is None else int.from_bytes(xxhash.xxh64_digest(text.encode(), 42), "big", signed=True)


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_tokenizers_ids(name, spaced, edge_texts):
    whole = plain(name)
    own = PieceEncoder(public_tokenizers.path(name), spaced, limit=50)
    texts = [t or "" for _, t in edge_texts] + ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|> z", "  <|endoftext|>  a  b", "<|endoftext| >"]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(pa.array(texts))]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x1c\x85  aZ'sé9.́"), st.characters(codec="utf-8")), max_size=40))
    def same(text):
        assert np.frombuffer(own.encode(pa.array([text]))[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    same()
    whole.encode_special_tokens = True
    as_text = PieceEncoder(public_tokenizers.path(name), spaced, special_as_text=True)
    for t in texts:
        assert np.frombuffer(as_text.encode(pa.array([t]))[0], "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_first_fit_decreasing_against_plain_search():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 101, n).tolist()
        bins = []
        want = [None] * n
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((b for b, used in enumerate(bins) if used + sizes[i] <= 100), len(bins))
            if b == len(bins):
                bins.append(0)
            want[i] = (b, bins[b])
            bins[b] += sizes[i]
        assert packing.first_fit_decreasing(sizes, 100) == want


def test_packing(spark, edge_texts):
    docs = make_docs(spark, edge_texts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack_documents(docs, path, with_ids=True, docs_per_group=30).collect()
    whole, want, got = plain("byte_bpe_50k.json"), Counter(), defaultdict(list)
    for i, t in edge_texts:
        want[i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    used = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and 0 < r.length <= 2048
        used[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id].append(r)
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    assert sum(r.length for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    for (i, ids), n in want.items():
        pieces = sorted((r for r in got[i] if r.doc_tokens == len(ids)), key=lambda r: r.start)
        if n == 1 and len([k for k in want if k[0] == i]) == 1:
            assert tuple(np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()) == ids
    assert packing.pack_documents(make_docs(spark, []), path).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 70), st.integers(0, 2**32), st.data())
def test_bits_round_trip(bits, n, seed, data):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, n).astype(np.uint32)
    packed = bitpack.pack(ids, bits)
    assert len(packed) == -(-n // 8) * bits
    start = data.draw(st.integers(0, n))
    count = data.draw(st.integers(0, n - start))
    assert bitpack.unpack(packed, bits, start, count).tolist() == ids[start : start + count].tolist()


def test_token_files(spark, edge_texts, tmp_path):
    docs = make_docs(spark, edge_texts)
    path = f"file://{tmp_path}/tokens"
    rows = bitpack.token_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408, path=path, block_tokens=500, part_bytes=20_000).collect()
    whole = plain("word_bpe_49k.json")
    at, want, every = 0, [], []
    for i, t in sorted(edge_texts, key=lambda x: (x[0] is not None, x[0], spark_hash(x[1]))):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
        every += ids.tolist()
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == [(a, i, n, c) for i, a, n, c in want]
    blocks = spark.read.parquet(path).collect()
    assert len(blocks) > 3 and {b.bits for b in blocks} == {16}
    for a, b in ((0, 5), (490, 1510), (at - 3, at + 9), (7, 7), (0, at)):
        got = bitpack.read_token_range(spark, path, a, b).orderBy("start").collect()
        assert [x for r in got for x in r.ids] == every[a:b] and (not got or got[0].start == a)
    long = max((w for w in want if w[0] is not None), key=lambda w: w[2])
    own = bitpack.read_document_range(spark, path, long[0], 11, 2500).collect()
    assert [r.ids for r in own] == [every[long[1] + 11 : long[1] + 2500]] and bitpack.read_document_range(spark, path, -5, 0, 9).collect() == []
    assert len(bitpack.read_document_range(spark, path, 3, 0, 1).collect()) == sum(i == 3 for i, _ in edge_texts)
    empty = bitpack.token_round_trip(make_docs(spark, []), public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    assert empty.collect() == []
