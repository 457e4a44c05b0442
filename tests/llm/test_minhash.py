from collections import defaultdict

import numpy as np
from conftest import make_docs

import corpus_pipeline
from lodestone.llm import minhash, simhash


def brute_first(texts):
    """The smallest doc_id of each component of pairs with a similarity of 0.8 or more."""

    def grams(t):
        own = (t or "").lower().split()
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}

    sets = [grams(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 9 * shared >= 4 * (len(sets[i]) + len(sets[j])):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (x, _) in enumerate(texts):
        least[root(i)].append(x)
    return sorted(min(x) for x in least.values())


def near_copies(rng):
    words = [f"w{i}" for i in range(900)]
    texts = []
    for k in range(30):
        base = rng.choice(words, 200).tolist()
        texts.append((100 * k, " ".join(base)))
        for v in range(1, 5):
            own = list(base)
            for place in rng.choice(40, v + 1, replace=False):
                own[int(place) * 5 + 2] = f"new{k}x{v}x{place}"
            texts.append((100 * k + v, " ".join(own)))
    return texts


def test_near_duplicates_stage_finds_jaccard_pairs(spark):
    rng = np.random.default_rng(11)
    texts = near_copies(rng)
    assert 30 < len(brute_first(texts)) < 150
    docs = make_docs(spark, texts)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == brute_first(texts)


def test_large_group_and_shared_passages(spark, edge_texts):
    rng = np.random.default_rng(12)
    words = [f"v{i}" for i in range(900)]
    base, passage = rng.choice(words, 300).tolist(), rng.choice(words, 60).tolist()
    texts = []
    for k in range(120):  # each within 0.8 of the first, and mostly not of each other
        own = list(base)
        for place in rng.choice(60, 5, replace=False):
            own[int(place) * 5 + 2] = f"new{k}x{place}"
        texts.append((1000 + k, " ".join(own)))
    texts += [(2000, " ".join(base)), (3000, None), (3001, ""), (3002, " \n"), (3003, "one two"), (3004, "ONE  two")]
    texts += [(4000 + k, " ".join([*passage, *rng.choice(words, 30).tolist()])) for k in range(120)]
    kept = simhash.keep_one(make_docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == brute_first(texts)
    assert simhash.keep_one(make_docs(spark, [])).collect() == []
    odd = simhash.keep_one(make_docs(spark, edge_texts)).collect()
    assert len({(r.doc_id, r.text) for r in odd}) == len(odd) and (None, "no id") in {(r.doc_id, r.text) for r in odd}


def test_chunks_of_a_cluster_and_columns_of_any_name(spark, monkeypatch):
    rng = np.random.default_rng(13)
    texts = near_copies(rng)
    frame = make_docs(spark, texts).selectExpr("*", "'k' as _key", "1 as node", "2 as key", "3 as id")
    monkeypatch.setattr(minhash, "CHUNK", 3)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r._key, r.node) for r in kept.collect()) == [(i, "k", 1) for i in brute_first(texts)]


def test_shared_counts():
    rng = np.random.default_rng(14)
    sets = [np.unique(rng.integers(0, 50, n)) for n in rng.integers(0, 40, 30)]
    want = np.array([[len(set(a.tolist()) & set(b.tolist())) if i != j else len(a) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    got = minhash.shared_counts(sets, 30)
    off = ~np.eye(30, dtype=bool)
    assert (got[off] == want[off]).all() and (minhash.shared_counts(sets, 12) == want[:12, 12:]).all()
