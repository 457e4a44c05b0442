import math
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import cards, graph, report, retrieval, sampling, tasks


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())).select(column).first()[0]


def test_tokens_of_both_scripts(spark):
    for text in ("Hello für World-2", "人文社科 经济学 abc", "", "数a据"):
        assert one(spark, T.tokens(F.col("t")), t=text) == T.token_list(text)
    assert T.token_list("经济学 x1") == ["x1", "经", "济", "学", "经济", "济学"]


@pytest.mark.parametrize(("size", "overlap"), [(10, 3), (5, 5), (100, 10), (0, 0)])
def test_chunks(spark, size, overlap):
    for text in ("", "  ab  ", "abcdefghij klmnopqrst uvwxyz  " * 2, "   " * 9):
        want, at = [], 0
        while size > 0:
            want.append(text[at : at + size].strip())
            if at + size >= len(text):
                break
            at += max(size - overlap, 1)
        want = [x for x in want or [text.strip()] if x]
        assert one(spark, T.chunks(F.col("t"), size, overlap), t=text) == want


def test_urls(spark):
    def form(url):
        u = urlsplit(url)
        kept = [(k, v) for k, v in parse_qsl(u.query, keep_blank_values=True) if not k.lower().startswith("utm_")]
        return urlunsplit((u.scheme.lower(), u.netloc.lower(), u.path.rstrip("/"), urlencode(kept), ""))

    plain = ["HTTPS://News.Site/a/b//?UTM_Id=7&q=x+y&empty=&flag#part", "ftp://H:21/%41?z=%C3%A9&z=a%20b*~&&=v", "no-scheme/path/?a=b=c", "//host/x?utm_a", "mailto:me@x.y", "", "http://h?k=%zz", "HTTP://A.B", "a:b:c/d"]
    frame = spark.createDataFrame([(f"  {u}\n",) for u in plain] + [("http://[bad/x/",), (None,)], "u string")
    assert [r[0] for r in frame.select(T.normal_url("u")).collect()] == [*map(form, plain), "http://[bad/x/", None]


def test_json_part(spark):
    for text, want in (('```json\n{"a": 1}\n```', '{"a": 1}'), ('Sure: {"a": [1]} done', '{"a": [1]}'), ("x [1, 2] y", "[1, 2]"), ("none", None), ("", None)):
        assert one(spark, T.json_part(F.col("t")), t=text) == want


def test_frontier_orders(spark):
    rows = [("S0", "S0", 0, 1), ("S1", "S1", 0, 2), ("A", "S0", 1, 3), ("B", "S0", 2, 4), ("A", "S0", 1, 5)]
    queue = spark.createDataFrame(rows, "id string, seed string, level int, seq int")
    for policy, want in (("bfs", "S0 S1 A B"), ("dfs", "B A S1 S0"), ("balanced", "B S1 A S0")):
        assert " ".join(r.id for r in sampling.frontier_order(queue, policy).orderBy("pos").collect()) == want
    with pytest.raises(ValueError, match="queue_policy"):
        sampling.frontier_order(queue, "best")


def test_quotas_and_weights(spark):
    assert sampling.split_quota(12, 0.25, 0.5, 0.25) == {"breadth": 3, "depth": 6, "joint": 3}
    assert sampling.split_quota(7, 0.2, 0.6, 0.2) == {"breadth": 1, "depth": 4, "joint": 2}
    assert sampling.split_quota(4, -1, 0, 0) == {"breadth": 0, "depth": 0, "joint": 4}
    with pytest.raises(ValueError, match="inverse_frequency"):
        sampling.weight("other", F.lit(1))


def test_levels_find_the_shortest_way(spark):
    nodes = spark.createDataFrame([(x, x, "expanding") for x in "RABCX"] + [("M", "M", "merged")], "id string, label string, status string")
    edges = spark.createDataFrame([("R", "A"), ("A", "B"), ("B", "C"), ("R", "C"), ("X", "C"), ("M", "A")], "parent string, child string").selectExpr("*", "'is_subconcept' as relation", "1d as confidence")
    assert {r.id: r.level for r in graph.levels(nodes, edges).collect()} == {"R": 0, "X": 0, "A": 1, "B": 2, "C": 1}
    kept, bad = graph.add_edges(edges, spark.createDataFrame([("C", "R", "is_subconcept", 1.0), ("C", "Q", "is_subconcept", 1.0), ("A", "X", "is_related", 1.0)], edges.schema), nodes)
    assert {(r.parent, r.child, r.reason) for r in bad.collect()} == {("C", "R", "cycle_prevented"), ("C", "Q", "unknown_node")}
    assert kept.count() == 7


def test_leaves_stand_in_for_atomic_nodes(spark):
    nodes = spark.createDataFrame([("a", "expanding"), ("b", "expanding"), ("c", "merged")], "id string, status string")
    edges = spark.createDataFrame([("a", "b", "is_subconcept")], "parent string, child string, relation string")
    assert [r.id for r in sampling.depth_pool(nodes, edges).collect()] == ["b"]


def test_query_shapes(spark):
    path = [" Cooking", "", "Bread", "sour dough", "Starter "]
    rows = [("starter", path, x, []) for x in ("web", "github", "arxiv", "local")] + [("starter", [], x, []) for x in ("web", "github", "arxiv")] + [("starter", ["Cooking"], "local", ["starter", " levain ", "", "starter"])]
    found = [r.queries for r in retrieval.query_shapes(spark.createDataFrame(rows, "label string, path array<string>, source_type string, others array<string>")).collect()]
    assert found == [
        ["Bread sour dough starter", "Bread sour dough starter tutorial", "starter in sour dough guide"], ["Cooking Bread sour dough starter", "starter topic:sour-dough"], ['"Bread sour dough starter"'], ["Cooking Bread sour dough starter"],
        ["starter", "starter tutorial"], ["starter", "starter topic:starter"], ['"starter"'], ["Cooking starter", "starter AND levain"],
    ]


def test_duplicates_inside_bundles(spark):
    rows = [("b1", 0, "m1", "https://A.b/x?utm_s=1", None, "t", "one text of some words here", ""), ("b1", 1, "m2", "https://a.b/x/", None, "t", "one text of some words here", ""), ("b1", 2, "m3", None, "p", "t", "quite another thing is said", ""), ("b1", 3, "m4", None, "p", "t", "", "a snippet only"), ("b2", 4, "m1", "https://a.b/x", None, "t", "one text of some words here", ""), ("b2", 5, "m5", None, None, "t", "x", ""), ("b2", 6, "m6", None, None, "t", "x", "")]
    frame = spark.createDataFrame(rows, "bundle_id string, ord int, material_id string, uri string, path string, title string, text string, snippet string")
    kept = lambda mode: sorted(r.ord for r in retrieval.deduplicated(frame, mode).collect())
    assert kept("off") == kept("none") == list(range(7)) and kept("url") == [0, 2, 4, 5, 6] and kept("simhash") == [0, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="simhash"):
        retrieval.deduplicated(frame, "best")


def test_one_cap_over_all_intents(spark):
    nodes = spark.createDataFrame([(x, x, i // 3, "atomic" if i > 2 else "expanding") for i, x in enumerate("abcdefg")], "id string, label string, level int, status string")
    edges = spark.createDataFrame([("a", x, "is_subconcept") for x in "defg"], "parent string, child string, relation string")
    sampled = nodes.select("id", F.lit(0).alias("times_sampled"))
    drawn = sampling.draw_all(nodes, edges, sampled, {"breadth": 9, "depth": 9, "joint": 9}, seed=1, cap=3)
    rows = drawn.collect()
    picks = [x for r in rows for x in r.nodes]
    assert all(picks.count(x) <= 3 for x in set(picks)) and {r.intent for r in rows} >= {"breadth", "depth"}
    assert {x for r in rows if r.intent == "breadth" for x in r.nodes} >= set("abc")
    counted = {r.id: r.times_sampled for r in sampling.count_samples(nodes, drawn).collect()}
    assert counted == {x: picks.count(x) for x in "abcdefg"}
    with pytest.raises(ValueError, match="inverse_frequency"):
        sampling.draw_all(nodes, edges, sampled, {"breadth": 1, "depth": 0, "joint": 0}, seed=1, cap=3, prioritizer="ece")


def test_best_matches_against_all_products(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice(words, int(rng.integers(1, 25))))) for i in range(300)] + [(300 + i, "w1 w2 w3") for i in range(20)]
    asked = [(i, " ".join(rng.choice(words, 5))) for i in range(30)] + [(99, "nothing known"), (100, "w1 w2")]
    docs, queries = spark.createDataFrame(texts, "chunk_id int, text string"), spark.createDataFrame(asked, "qid int, text string")
    idf = {w: math.log((len(texts) + 1) / (sum(w in t.split() for _, t in texts) + 1)) + 1 for w in words}
    vector = lambda t: {w: (1 + math.log(t.split().count(w))) * idf.get(w, 0) for w in set(t.split())}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = []
    for q, t in asked:
        a = vector(t)
        scores = sorted((-round(sum(x * v.get(w, 0) for w, x in a.items()) / (length(a) * length(v)), 9), i) for i, v in ((i, vector(x)) for i, x in texts) if set(a) & set(v))
        want += [(q, i, -s) for s, i in scores[:4]]
    got = [(r.qid, r.chunk_id, r.score) for r in retrieval.tfidf_search(docs, queries, 4).orderBy("qid", "rank").collect()]
    assert [x[:2] for x in got] == [x[:2] for x in want] and all(abs(a[2] - b[2]) < 1e-8 for a, b in zip(got, want, strict=True))


def test_levels_of_a_long_chain(spark):
    nodes = spark.createDataFrame([(f"n{i}", f"n{i}", "expanding") for i in range(30)], "id string, label string, status string")
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}", "is_subconcept") for i in range(29)], "parent string, child string, relation string")
    assert graph.levels(nodes, edges).agg(F.max("level")).first()[0] == 29
    assert graph.closure(edges, spark.createDataFrame([("n29",)], "id string")).count() == 29


def test_cards(spark):
    nodes = spark.createDataFrame([("r", "Root", 0, "expanding", "", 0), ("c", "Child", 1, "atomic", "d", 0), ("m", "Gone", 1, "merged", "", 9)], "id string, label string, level int, status string, description string, n_materials int")
    edges = spark.createDataFrame([("r", "c")], "parent string, child string")
    found = cards.stats(nodes, edges)
    assert found["nodes"] == 2 and found["edges"] == 1 and found["seeds"] == ["Root"] and found["described"] == {"0": "0/1", "1": "1/1"} and found["max_level"] == 1
    one = cards.revised(None, "g", found, {"max_depth": 6}, "h", "t1")
    assert one.revision == 1 and len(one.notes) == 3 and cards.revised(one, "g", found, {"max_depth": 6}, "h", "t2") is one
    two = cards.revised(one, "other", found, {"max_depth": 6}, "h", "t2")
    assert two.revision == 2 and two.history[-1]["note"] == "renamed" and two.history[-1]["delta_nodes"] == 0 and two.created_at == "t1"
    assert cards.Card.read(cards.card_json(two)) == two and cards.Card.read({"odd": 1}) is None and cards.Card.read([]) is None
    assert cards.card_text(two).startswith("# other, revision 2\n")
    many = two
    for i in range(60):
        many = cards.revised(many, "g", found | {"nodes": i}, {}, "h", f"t{i}")
    assert len(many.history) == cards.HISTORY and many.revision == 62


def test_task_types(spark):
    tasks.register_task_type("own_type", 3, "answer_match")
    try:
        assert tasks.get_task_type("own_type") == (3, "answer_match") and "own_type" in tasks.list_task_types() and tasks.task_types(spark).count() == 6
        with pytest.raises(ValueError, match="known"):
            tasks.get_task_type("none")
    finally:
        tasks._REGISTRY.pop("own_type")


def test_context_blocks(spark):
    own = spark.createDataFrame([("t1", "ZH-cn", ["a", "b", "c", "d"]), ("t2", None, ["d"]), ("t3", "en", ["x"])], "task_id string, language string, materials array<string>")
    materials = spark.createDataFrame([("a", None, "\u3000one\n", "s", 1.0), ("b", "B", " \t", "snippet", 1.0), ("c", "C", None, "from snippet", 1.0), ("d", "D", "y" * 50, "", 1.0)], "material_id string, title string, text string, snippet string, quality_score double")
    got = {r.task_id: r.context for r in tasks.context_blocks(own, materials, 20).collect()}
    assert got == {"t1": "材料：\n[a] \none\n\n[c] C\nfrom snippet\n\n[d] D\nyyyyy\n\n问题：", "t2": "Materials:\n[d] D\n" + "y" * 20 + "\n\nQuestion：", "t3": ""}


def test_verification(spark):
    frame = spark.createDataFrame([("see [m_1].", ["m_1"]), ("no", ["m_1"]), (" ", ["m_1"]), ("x", [])], "a string, m array<string>")
    assert [r[0].result for r in frame.select(tasks.answer_match(F.col("a"), F.col("m"))).collect()] == ["pass", "fail", "fail", "fail"]
    scores = spark.createDataFrame([([0.9, 0.8],), ([0.2, 0.4],), ([],), (None,), ([0.9, None],)], "s array<double>")
    assert [r[0].result for r in scores.select(tasks.rubric_mean(F.col("s"))).collect()] == ["pass", "fail", "fail", "fail", "fail"]


def test_export_files(spark, tmp_path):
    own = spark.createDataFrame([("t1", "atomic_qa", "pass", "answer_match", "q", "a", ["r"]), ("t2", "atomic_qa", "fail", None, "q", "a", [])], "task_id string, task_type string, verify_result string, verifier string, question string, answer string, rubric array<string>")
    contexts = spark.createDataFrame([("t1", "材料：x")], "task_id string, context string")
    assert tasks.write_export(own, contexts, "rl", f"{tmp_path}/rl") == 1
    assert spark.read.text(f"{tmp_path}/rl").first()[0] == '{"task_id":"t1","prompt":"q","context":"材料：x","rubric":["r"],"verifier":"answer_match","env":null}'
    with pytest.raises(ValueError, match="sft or rl"):
        tasks.write_export(own, contexts, "csv", f"{tmp_path}/x")


def test_empty_reports(spark):
    none = spark.createDataFrame([], "task_id string, question string, materials array<string>, nodes array<string>")
    assert report.jaccard_mean(none).first()[0] == 0.0
    assert report.material_reuse(none).first().reuse_rate == 0.0


def test_near_pairs_are_not_broadcast(spark):
    prints = spark.range(50).select("id", F.xxhash64("id").alias("fp"))
    assert "Broadcast" not in retrieval.near_pairs(prints)._jdf.queryExecution().executedPlan().toString()


def test_first_of_near_ones_in_chains(spark):
    rows = [(i, (1 << i % 20 + 1) - 1) for i in (4, 1, 7, 9, 2, 30, 31, 12, 55)] + [(100, 1 << 60), (3, -1), (None, 1 << 40 | 1 << 50)]
    kept, ids = [], sorted(i for i, _ in rows if i is not None)
    bits = {i: fp & (2**64 - 1) for i, fp in rows}
    for i in ids:
        if all((bits[i] ^ bits[j]).bit_count() > 3 for j in kept):
            kept.append(i)
    got = [r.id for r in retrieval.keep_first_near(spark.createDataFrame(rows, "id long, fp long")).collect()]
    assert sorted(x for x in got if x is not None) == kept and None in got


def test_postings_of_repeated_and_empty_keys(spark):
    rows = [(1, "b a b 经济 B"), (2, "x"), (1, "a c"), (None, "n n"), (None, "n"), (3, ""), (4, None), (5, "经济学 7")]
    want = {}
    for k, text in rows:
        for t in T.token_list(text):
            want[k, t] = want.get((k, t), 0) + 1
    for some in (rows, rows[1:3] + rows[5:]):
        posted = retrieval.postings(spark.createDataFrame(some, "k long, text string"), "k")
        assert posted.schema["tf"].dataType.simpleString() == "bigint"
        got = [((r.k, r.term), r.tf) for r in posted.collect()]
        assert len(got) == len(dict(got)) and dict(got) == {k: n for k, n in want.items() if some is rows or k[0] in (2, 5)} | ({} if some is rows else {(1, "a"): 1, (1, "c"): 1})


def test_terms_are_counted_without_a_map_over_a_task(spark):
    posted = retrieval.postings(spark.range(9).selectExpr("id", "concat('a b a ', id) as text"), "id")
    assert "Aggregate" not in posted._jdf.queryExecution().executedPlan().toString()


def test_means_at_the_pass_score(spark):
    nan, inf = float("nan"), float("inf")
    rows = [[0.1] * 3, [0.3, 0.7, 0.5], [0.7, 0.3, 0.5], [0.29, 0.71 - 2e-11, 0.5], [29.27 / 100] * 3 + [70.73 / 100] * 3, [inf, 0.0], [-inf, 1.0], [nan], [1e300, 0.2]]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s array<double>").orderBy("i")
    got = [r[0].result for r in frame.select(tasks.rubric_mean(F.col("s"), 0.5)).collect()]
    assert got == ["fail", "pass", "pass", "fail", "pass", "pass", "fail", "pass", "pass"]
    tenths = spark.createDataFrame([([0.1] * 10,), ([0.6, 0.1, 0.1, 0.1, 0.1, 0.0, 0.0, 0.0, 0.0, 0.0],)], "s array<double>")
    assert [r[0].result for r in tenths.select(tasks.rubric_mean(F.col("s"), 0.1)).collect()] == ["pass", "pass"]


def test_rubric_of_events_without_value(spark, tmp_path):
    from lodestone.plans.queries import QUERIES

    spark.createDataFrame([(1, 90.0), (1, None), (2, 50.0), (3, None), (4, 40.0)], "user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert {r.user_id: r.result for r in QUERIES["rubric_mean"](spark, str(tmp_path)).collect()} == {1: "fail", 2: "pass", 3: "fail", 4: "fail"}


def test_fingerprints_make_objects_of_slices_only(spark):
    texts = ["a b c d e", None, "", "x y", "经济学 f g h " * 500, "q " * 9000]
    want = [T.simhash_one(t) for t in texts]
    assert want[1] == want[2] == 0 and len(set(want)) == 5
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts * 3], "t string").coalesce(1).select(T.simhash64("t")).collect()] == want * 3
    assert T.slices_of(np.array([5, 0, 3, 9, 0, 20, 1]), 8) == [(0, 3), (3, 4), (4, 6), (6, 7)]
    assert T.slices_of(np.array([], int), 8) == []


@pytest.mark.parametrize(("words", "most"), [(400, 2_000_000), (400, 50), (12, 2_000_000), (400, 3)])
def test_pairs_that_share_elements(words, most):
    from lodestone.functions.blocks import shared_pairs

    rng = np.random.default_rng(5)
    left, right = ([rng.permutation(words)[: rng.integers(0, 12)].astype(np.int64) for _ in range(k)] for k in (37, 37))
    want = {(i, j): len({*x} & {*y}) for i, x in enumerate(left) for j, y in enumerate(right) if {*x} & {*y}}
    parts = list(shared_pairs(left, right, most, 8))
    got = [((i, j), n) for part in parts for i, j, n in zip(*(x.tolist() for x in part), strict=True)]
    assert len(got) == len(want) and dict(got) == want and (most != 50 or len(parts) > 2)
    assert list(shared_pairs([], right)) == [] == list(shared_pairs(left[:1], [np.zeros(0, np.int64)]))


def test_mean_similarity_in_chunks(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "b", "c", "d"], rng.integers(0, 9))) for _ in range(60)] + ["only once here"] * 2
    sets = [(lambda w: {*w} if len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)})(t.split()) for t in texts]
    pairs = [(x, y) for i, x in enumerate(sets) for y in sets[:i]]
    want = sum(len(x & y) / max(1, len(x | y)) for x, y in pairs) / len(pairs)
    frame = spark.createDataFrame([(t,) for t in texts], "question string")
    for chunk in (8192, 9):
        assert abs(report.jaccard_mean(frame, chunk=chunk).first()[0] - want) < 1e-6
