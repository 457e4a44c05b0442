import zlib
from collections import defaultdict

import numpy as np
import xxhash
from conftest import make_docs

from lodestone.llm import sharding, simhash


def test_sharding(spark, edge_texts, tmp_path):
    texts = [*edge_texts, *[(7000 + i, f"text {i}") for i in range(500)]]
    rows = sharding.shard_documents(make_docs(spark, texts), path=f"file://{tmp_path}/s", shards=7, bucket_bytes=4000).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in rows) == sorted((str(i), t or "") for i, t in texts)
    slots, shard_of = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, 7)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(7))
    assert 40 < sum(r.grown_shard == 7 for r in rows) < 120
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)) if r.doc_id and r.doc_id >= 7000]
    steps = np.diff(order)
    assert 0.35 < (steps > 0).mean() < 0.65  # not in the old order
    again = sharding.shard_documents(make_docs(spark, texts), shards=7, bucket_bytes=4000).collect()
    key = lambda r: (r.shard, r.slot, r.doc_id, zlib.crc32((r.text or "").encode()))
    assert sorted(map(str, map(key, rows))) == sorted(map(str, map(key, again)))
    assert sharding.shard_documents(make_docs(spark, [])).collect() == []


def brute_fingerprint(text, words=3):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    grams = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=3):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)].append(x)
    return [min(least[root(i)], default=None) for i in range(len(ids))]


def test_masks_cover_every_small_difference():
    import itertools

    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        x = sum(1 << b for b in bits)
        assert any(not m & x for m in masks)


def test_simhash(spark, edge_texts):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    near = []
    for k in range(12):
        base = rng.choice(words, 600).tolist()
        for v in range(6):
            base = list(base)
            base[int(rng.integers(600))] = "CHANGED"
            near.append((10_000 + 10 * k + v, " ".join(base)))
    texts = [*edge_texts, *near]
    fps = [brute_fingerprint(t) for _, t in texts]
    want = sorted(zip([str(i) for i, _ in texts], [f"{f:016x}" for f in fps], map(str, brute_components([i for i, _ in texts], fps)), strict=True))
    for bucket in (8192, 2):  # the second goes through all levels
        rows = simhash.simhash_groups(make_docs(spark, texts), bucket=bucket).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.simhash_groups(make_docs(spark, [])).collect() == []


def test_large_bucket_is_searched_whole():
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 2**63, 40).astype(np.uint64)[:, None] ^ (np.uint64(1) << rng.integers(0, 20, (40, 30)).astype(np.uint64)))
    links = list(simhash._links(fps, 3))
    assert len(links) <= len(fps) - 1 and all((a ^ b).bit_count() <= 3 for a, b in links)
    index = {int(f): i for i, f in enumerate(fps)}
    comp = brute_components(list(range(len(fps))), [int(f) for f in fps])
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(index[a])] = root(index[b])
    assert len({root(i) for i in range(len(fps))}) == len(set(comp))
