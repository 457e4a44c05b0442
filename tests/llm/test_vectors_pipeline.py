import math
from collections import defaultdict

import numpy as np
from conftest import make_docs

import corpus_pipeline
from lodestone.llm import embed_dedup


def brute_vectors(rows, threshold=0.93):
    def unit(v, label):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        return v / np.linalg.norm(v)

    own = [unit(v, label) for _, v, label in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if own[i] is not None and own[j] is not None and rows[i][2] == rows[j][2] and len(own[i]) == len(own[j]) and own[i] @ own[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root(i)].append(r[0])
    return [(r[0], links[i], min(least[root(i)]), r[0] == min(least[root(i)])) for i, r in enumerate(rows)]


def test_embedding_links(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), (base + rng.normal(0, rng.choice([0.05, 0.1, 0.2]), 16)).astype(np.float32).tolist(), int(k % 3)))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(30)] + [(2000, rows[3][1], None), (2001, None, 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None, *[1.0] * 15], 1), (2005, [], 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [1e-30] * 16, 1), (2009, [3e38] * 16, 1), (2010, [float("inf"), *[1.0] * 15], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 as component_id", "'k' as key", "2 as weight")
    seen = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").collect()
    want = sorted(brute_vectors([(r.vec_id, r.embedding, r.label) for r in seen]))
    for chunk in (16_384, 20):
        assert sorted(tuple(r) for r in embed_dedup.embedding_links(frame, chunk=chunk).collect()) == want
    assert embed_dedup.embedding_links(frame.where("false")).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(30, 64))
    v = np.repeat(base, 10, 0) + rng.normal(0, 0.27, (300, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    own = embed_dedup.Rounded.of(v)
    i, j, oi, oj = embed_dedup.tile_links(own, own, 0.93)
    links = set(zip(*(x.tolist() for x in np.nonzero(v @ v.T >= 0.93)), strict=True))
    sure, left = set(zip(i.tolist(), j.tolist(), strict=True)), set(zip(oi.tolist(), oj.tolist(), strict=True))
    assert sure <= links <= sure | left and len(sure) > 600 and len(left) < 40
    # at the threshold itself nothing is sure
    i, j, oi, oj = embed_dedup.tile_links(own, own, float(v[0] @ v[1]))
    assert (0, 1) in set(zip(oi.tolist(), oj.tolist(), strict=True))


def test_stages(spark, edge_texts, tmp_path):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("th", "er", "on", "re") for b in ("an", "in", "st", "le", "ha", "nd")]
    say = lambda n: " ".join(rng.choice(words, n).tolist())
    item = say(30)
    texts = [(i, say(80) + ".") for i in range(200)]
    texts += [(300 + i, " ".join(w + "###" for w in say(60).split())) for i in range(40)]
    texts += [(400, texts[5][1]), (5, texts[5][1]), (401, f"{say(30)} {item} {say(30)}"), (402, f"{say(40)} write to me@example.com now {say(30)}")]
    make_docs(spark, [*texts, (500, None), (501, "")]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300)) for i, _ in texts if i < 400 and i != 5], "doc_id bigint, quality int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"file://{tmp_path}/{name}"
        stage(spark, docs, f"file://{tmp_path}").write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not any(300 <= i < 340 for i in kept["quality"]) and set(range(200)) <= set(kept["quality"])
    assert 400 not in kept["near_duplicates"] and docs.where("doc_id = 5").count() == 1 and set(range(200)) <= set(kept["near_duplicates"])
    assert 401 in kept["near_duplicates"] and 401 not in kept["decontamination"] and set(range(200)) <= set(kept["decontamination"])
    assert "me@example.com" not in kept["personal_data"][402] and "[EMAIL]" in kept["personal_data"][402]
    packed = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert {r.doc_id for r in packed} == set(kept["personal_data"])
