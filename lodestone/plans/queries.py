"""Queries over the test tables for each operator, and the SQL that each must agree with.

The tables hold no concept graph, so one is derived from them: regions, nations and market segments are levels 0, 1 and 2; documents
are materials; a user's turn and the answer to it are a task. Each derived table is one statement that both engines read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import graph, report, retrieval, sampling, tasks
from lodestone.plans.retrieve import targets
from lodestone.sources.corpus import ExtractionSpec, record_text

DERIVED = {
    "kg_nodes": """
SELECT concat('r', r_regionkey) AS id, r_name AS label, 0 AS level, 'expanding' AS status, 'region' AS description, CAST(0 AS BIGINT) AS n_materials, CAST(r_regionkey AS BIGINT) AS ord FROM {region}
UNION ALL SELECT concat('n', n_nationkey), n_name, 1, CASE WHEN n_nationkey % 11 = 10 THEN 'merged' ELSE 'expanding' END, '', 3, CAST(100 + n_nationkey AS BIGINT) FROM {nation}
UNION ALL SELECT DISTINCT concat('n', c_nationkey, '-', c_mktsegment), concat(c_mktsegment, ' ', c_nationkey), 2, 'atomic', 'segment', 7, CAST(1000 + c_nationkey AS BIGINT) FROM {customer}""",
    "kg_edges": """
SELECT concat('r', n_regionkey) AS parent, concat('n', n_nationkey) AS child, 'is_subconcept' AS relation, 1e0 AS confidence FROM {nation}
UNION ALL SELECT DISTINCT concat('n', c_nationkey), concat('n', c_nationkey, '-', c_mktsegment), 'is_subconcept', 5e-1 FROM {customer}
UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), 'is_related', 2e-1 FROM {nation} WHERE n_nationkey % 5 = 0""",
    "part_nodes": """
SELECT DISTINCT concat('b', p_brand) AS id, p_brand AS label, 0 AS level, 'expanding' AS status FROM {part}
UNION ALL SELECT DISTINCT concat('t', p_type), p_type, 1, 'expanding' FROM {part}
UNION ALL SELECT DISTINCT concat('s', p_size), concat('size ', p_size), 2, 'atomic' FROM {part}""",
    "part_edges": """
SELECT DISTINCT concat('b', p_brand) AS parent, concat('t', p_type) AS child, 'is_subconcept' AS relation, length(p_type) * 1e0 AS confidence FROM {part}
UNION ALL SELECT DISTINCT concat('t', p_type), concat('s', p_size), 'is_subconcept', length(p_type) * 1e0 FROM {part}
UNION ALL SELECT DISTINCT concat('b', p_brand), concat('s', p_size), 'is_subconcept', length(p_brand) * 1e0 FROM {part} WHERE p_size % 4 = 0
UNION ALL SELECT DISTINCT concat('s', p_size), concat('s', p_size + 1), 'is_subconcept', 1e0 FROM {part} WHERE p_size % 10 = 3""",
    "materials": """
SELECT concat('m', doc_id) AS material_id, doc_id AS ord, CASE doc_id % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'local' WHEN 2 THEN 'github' ELSE 'web' END AS source_type,
 CASE doc_id % 7 WHEN 0 THEN 'CC-BY' WHEN 1 THEN NULL WHEN 2 THEN 'all-rights-reserved' WHEN 3 THEN 'MIT' WHEN 4 THEN '' ELSE 'proprietary' END AS license,
 (doc_id % 100) / 100e0 AS quality_score, left(text, 40) AS title, left(text, 200) AS snippet, text,
 {array}(concat('n', doc_id % 25), concat('n', (doc_id * 3) % 25)) AS linked_nodes FROM {documents}""",
    "tasks": """
SELECT concat('t', u.conv_id, '-', u.turn) AS task_id, CASE u.conv_id % 5 WHEN 0 THEN 'atomic_qa' WHEN 1 THEN 'aggregated_qa' WHEN 2 THEN 'multihop_qa' WHEN 3 THEN 'grounded_summary' ELSE 'comparative_analysis' END AS task_type,
 u.conv_id % 3 AS level, CASE u.conv_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'sft_only' ELSE 'pass' END AS verify_result, CASE u.conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'answer_match' ELSE 'exact' END AS verifier,
 u.text AS question, concat(a.text, ' [M', u.conv_id % 50, ']') AS answer, CASE u.conv_id % 3 WHEN 0 THEN 'zh-CN' WHEN 1 THEN 'ZH' ELSE 'en' END AS language,
 {array}(concat('m', u.conv_id % 50), concat('m', (u.conv_id * 7) % 1200), concat('m', u.turn)) AS materials, {array}(concat('n', u.conv_id % 30), concat('r', u.turn % 5)) AS nodes
FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "bundles": """
SELECT concat('b', n_nationkey) AS bundle_id, CASE n_nationkey % 3 WHEN 0 THEN 'joint' ELSE 'depth' END AS intent, {array}(concat('n', n_nationkey), concat('n', (n_nationkey + 7) % 25)) AS nodes FROM {nation}""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derived(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.sql(DERIVED[name].format(array="array", **{t: f"parquet.`{sf}/{t}.parquet`" for t in TABLES}))


def _oracle(sql: str) -> str:
    """The SQL with the derived tables that it names before it; {x} is a derived table."""
    used = [n for n in DERIVED if re.search(rf"\b{n}\b", sql)]
    first = ", ".join(f"{n} AS ({DERIVED[n].format(array='list_value', **{t: t for t in TABLES})})" for n in used)
    if not first:
        return sql
    if sql.lstrip().upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {first}, {sql.lstrip()[14:]}"
    return f"WITH {first}, {sql.lstrip()[4:]}" if sql.lstrip().upper().startswith("WITH") else f"WITH {first} {sql}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


# graph


@query("SELECT id, CAST((SELECT count(*) FROM kg_edges WHERE child = id AND relation = 'is_subconcept') AS BIGINT) AS n_parents, CAST((SELECT count(*) FROM kg_edges WHERE parent = id AND relation = 'is_subconcept') AS BIGINT) AS n_children FROM kg_nodes WHERE status <> 'merged'")
def children_parents(s, d):
    return graph.degrees(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges"))


_WALK = "WITH RECURSIVE w AS (SELECT id, 0 AS level, [label] AS path FROM {n} WHERE status <> 'merged' AND id NOT IN (SELECT child FROM {e} WHERE relation = 'is_subconcept') UNION ALL SELECT e.child, w.level + 1, list_append(w.path, n.label) FROM w JOIN {e} e ON e.parent = w.id AND e.relation = 'is_subconcept' JOIN {n} n ON n.id = e.child)"


@query(_WALK.format(n="part_nodes", e="part_edges") + " SELECT n.id, CAST(coalesce(min(w.level), 0) AS INTEGER) AS level FROM part_nodes n LEFT JOIN w ON w.id = n.id GROUP BY n.id")
def node_levels(s, d):
    return graph.levels(derived(s, d, "part_nodes"), derived(s, d, "part_edges"))


@query(_WALK.format(n="part_nodes", e="part_edges") + " SELECT id, array_to_string(arg_min(path, struct_pack(n := len(path), p := path)), ' > ') AS path FROM w GROUP BY id")
def ancestor_paths(s, d):
    return graph.ancestor_paths(derived(s, d, "part_nodes"), derived(s, d, "part_edges")).select("id", F.array_join("path", " > ").alias("path"))


@query("WITH RECURSIVE a AS (SELECT child AS id, parent AS ancestor FROM part_edges WHERE relation = 'is_subconcept' UNION SELECT a.id, e.parent FROM a JOIN part_edges e ON e.child = a.ancestor) SELECT id, ancestor FROM a")
def ancestors_closure(s, d):
    return graph.closure(derived(s, d, "part_edges"))


@query("SELECT concat('  ', lower(label), ' ') AS label, id FROM kg_nodes WHERE status <> 'merged' UNION ALL SELECT concat('  ', lower(label), ' '), NULL FROM kg_nodes WHERE status = 'merged'")
def find_label(s, d):
    nodes = derived(s, d, "kg_nodes").withColumn("aliases", F.array(F.col("id")))
    return graph.find(nodes, nodes.select(F.concat(F.lit("  "), F.lower("label"), F.lit(" ")).alias("label"))).select("label", "id")


@query("SELECT id, label FROM kg_nodes UNION ALL SELECT concat('p', p_partkey), p_name FROM (SELECT *, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS r FROM part) WHERE r = 1 AND lower(p_name) NOT IN (SELECT lower(label) FROM kg_nodes)")
def insert_absent(s, d):
    nodes = derived(s, d, "kg_nodes").select("id", "label", "ord", F.array().cast("array<string>").alias("aliases"))
    more = table(s, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("label"), F.col("p_partkey").cast("long").alias("ord"), F.array().cast("array<string>").alias("aliases"))
    more = more.unionByName(nodes.withColumn("label", F.upper("label")))
    return graph.insert_absent(nodes, more).select("id", "label")


@query("WITH l AS (SELECT id, level FROM part_nodes) SELECT DISTINCT 'level_soft_violation' AS kind, e.parent, e.child, p.level AS parent_level, c.level AS child_level FROM part_edges e JOIN l p ON p.id = e.parent JOIN l c ON c.id = e.child WHERE c.level <= p.level")
def soft_violations(s, d):
    return graph.soft_violations(derived(s, d, "part_nodes").select("id", "level"), derived(s, d, "part_edges"))


@query("SELECT parent, child, r <= 3 AS kept FROM (SELECT *, row_number() OVER (PARTITION BY child ORDER BY confidence DESC, parent) AS r FROM part_edges)")
def parent_cap(s, d):
    kept, over = graph.cap_parents(derived(s, d, "part_edges"), 3)
    return kept.select("parent", "child", F.lit(True).alias("kept")).unionByName(over.select("parent", "child", F.lit(False).alias("kept")))


@query("SELECT parent, child, 'cycle_prevented' AS outcome FROM (SELECT child AS parent, parent AS child FROM part_edges WHERE parent LIKE 'b%' AND child LIKE 't%') UNION ALL SELECT parent, child, 'kept' FROM part_edges")
def add_edges(s, d):
    edges, nodes = derived(s, d, "part_edges"), derived(s, d, "part_nodes")
    # sizes may be missing at the ends of the added chains, so all ends are nodes here
    ends = edges.select(F.col("parent").alias("id")).unionByName(edges.select(F.col("child").alias("id"))).unionByName(nodes.select("id")).distinct()
    back = edges.where("parent like 'b%' and child like 't%'").select(F.col("child").alias("parent"), F.col("parent").alias("child"), "relation", "confidence")
    kept, bad = graph.add_edges(edges, back, ends)
    return kept.select("parent", "child", F.lit("kept").alias("outcome")).unionByName(bad.select("parent", "child", F.col("reason").alias("outcome")))


@query("""WITH m AS (SELECT concat('n', n_nationkey) AS dup, concat('n', n_nationkey - 1) AS canon FROM nation WHERE n_nationkey % 6 = 5),
x AS (SELECT coalesce(CASE WHEN relation = 'is_subconcept' THEN canon END, parent) AS parent, child, relation, CASE WHEN canon IS NOT NULL AND relation = 'is_subconcept' THEN 1 ELSE 0 END AS moved FROM kg_edges LEFT JOIN m ON dup = parent)
SELECT parent, child, relation FROM (SELECT *, row_number() OVER (PARTITION BY parent, child ORDER BY moved, relation) AS r FROM x WHERE parent <> child) WHERE r = 1""")
def merge_nodes(s, d):
    nodes = derived(s, d, "kg_nodes").withColumn("aliases", F.array().cast("array<string>"))
    pairs = table(s, d, "nation").where("n_nationkey % 6 = 5").select(F.concat(F.lit("n"), "n_nationkey").alias("dup"), F.concat(F.lit("n"), F.col("n_nationkey") - 1).alias("canon"))
    return graph.merge(nodes, derived(s, d, "kg_edges"), pairs)[1].select("parent", "child", "relation")


@query("""SELECT concat('"', id, '" [label="', label, '\\nL', level, ' ', status, '"];') AS line FROM kg_nodes WHERE status <> 'merged'
UNION ALL SELECT concat('"', parent, '" -> "', child, '" [style=', CASE WHEN relation = 'is_subconcept' THEN 'solid' ELSE 'dashed' END, '];') FROM kg_edges""")
def graph_dot(s, d):
    return graph.dot_lines(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges"))


@query("SELECT level, count(*) AS n_nodes, count(*) FILTER (status = 'atomic') AS n_atomic, count(*) FILTER (description <> '') AS n_described, count(*) FILTER (n_materials > 0) AS n_with_materials, CAST(coalesce(sum(k), 0) AS BIGINT) AS n_edges_in FROM kg_nodes LEFT JOIN (SELECT child, count(*) AS k FROM kg_edges GROUP BY child) ON child = id WHERE status <> 'merged' GROUP BY level")
def card_stats(s, d):
    return graph.card_stats(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges"))


@query("WITH c AS (SELECT event_type AS name, event_id AS seq, CAST(floor(value / 20) AS BIGINT) AS nodes, user_id % 2 AS edges FROM events), p AS (SELECT *, lag(nodes) OVER w AS pn, lag(edges) OVER w AS pe FROM c WINDOW w AS (PARTITION BY name ORDER BY seq)) SELECT name, seq, row_number() OVER (PARTITION BY name ORDER BY seq) AS revision, nodes - coalesce(pn, nodes) AS d_nodes, edges - coalesce(pe, edges) AS d_edges FROM p WHERE pn IS NULL OR pn <> nodes OR pe <> edges")
def card_history(s, d):
    cards = table(s, d, "events").select(F.col("event_type").alias("name"), F.col("event_id").alias("seq"), F.floor(F.col("value") / 20).alias("nodes"), (F.col("user_id") % 2).alias("edges"))
    return report.card_history(cards)


@query("SELECT id, kind, other FROM (SELECT child AS id, 'parent' AS kind, parent AS other FROM kg_edges WHERE relation = 'is_subconcept' UNION ALL SELECT parent, 'child', child FROM kg_edges WHERE relation = 'is_subconcept' UNION ALL SELECT parent, 'any child', child FROM kg_edges)")
def neighbours(s, d):
    edges, ids = derived(s, d, "kg_edges"), derived(s, d, "kg_nodes").select("id")
    parts = [("parent", graph.parents(edges, ids)), ("child", graph.children(edges, ids)), ("any child", graph.children(edges, ids, subconcept_only=False))]
    rows = [f.select("id", F.lit(k).alias("kind"), F.col(f.columns[1]).alias("other")) for k, f in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT id, id IN (SELECT id FROM kg_nodes) AS known FROM (SELECT concat('n', c_custkey) AS id FROM customer)")
def contains_node(s, d):
    return graph.contains(derived(s, d, "kg_nodes"), table(s, d, "customer").select(F.concat(F.lit("n"), "c_custkey").alias("id")))


@query("SELECT * FROM kg_nodes WHERE id IN (SELECT concat('n', c_custkey) FROM customer)")
def get_nodes(s, d):
    return graph.get(derived(s, d, "kg_nodes"), table(s, d, "customer").select(F.concat(F.lit("n"), "c_custkey").alias("id")))


@query("""SELECT 'node' AS part, concat('{"id":"', id, '","label":"', label, '","level":', level, ',"status":"', status, '"}') AS line FROM part_nodes WHERE status <> 'merged'
UNION ALL SELECT 'edge', concat('{"parent":"', parent, '","child":"', child, '","relation":"', relation, '"}') FROM part_edges""")
def graph_json(s, d):
    return graph.json_lines(derived(s, d, "part_nodes"), derived(s, d, "part_edges").drop("confidence"))


@query("SELECT id, 8 + 3 * (SELECT count(*) FROM kg_edges WHERE parent = id AND relation = 'is_subconcept') AS size, least(level, 6) AS colour, status = 'atomic' AS border FROM kg_nodes WHERE status <> 'merged'")
def graph_drawn(s, d):
    return graph.drawn(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges"))


@query("SELECT event_id, event_type AS kind FROM events WHERE event_type IN ('max_parents_exceeded', 'level_soft_violation') UNION ALL SELECT o_orderkey, 'level_soft_violation' FROM orders WHERE o_orderstatus = 'F'")
def review_queue(s, d):
    flags = table(s, d, "events").select("event_id", F.col("event_type").alias("kind")).unionByName(table(s, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.when(F.col("o_orderstatus") == "F", "level_soft_violation").otherwise("cycle_prevented").alias("kind")))
    return graph.review(flags, "parents")


# sampling


@query("SELECT id FROM kg_nodes WHERE status <> 'merged' AND level <= (SELECT quantile_cont(level, 0.5) FROM kg_nodes WHERE status <> 'merged')")
def breadth_pool(s, d):
    return sampling.breadth_pool(derived(s, d, "kg_nodes"))


@query("SELECT id FROM kg_nodes WHERE status = 'atomic'")
def depth_pool(s, d):
    return sampling.depth_pool(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges"))


_GROUPS = "WITH c AS (SELECT DISTINCT parent, child FROM kg_edges JOIN kg_nodes ON id = child WHERE relation = 'is_subconcept' AND status <> 'merged'), g2 AS (SELECT parent, [a.child, b.child] AS m FROM c a JOIN c b USING (parent) WHERE a.child < b.child), g3 AS (SELECT parent, list_append(m, child) AS m FROM g2 JOIN c USING (parent) WHERE child > m[2]), g4 AS (SELECT parent, list_append(m, child) AS m FROM g3 JOIN c USING (parent) WHERE child > m[3]) "


@query(_GROUPS + "SELECT DISTINCT array_to_string(m, '|') AS members FROM (SELECT m FROM g2 UNION ALL SELECT m FROM g3 UNION ALL SELECT m FROM g4)")
def joint_pool(s, d):
    return sampling.joint_pool(derived(s, d, "kg_nodes"), derived(s, d, "kg_edges")).select(F.array_join("members", "|").alias("members"))


@query("SELECT event_id, CAST(floor(n * a / t) AS BIGINT) AS breadth, CAST(floor(n * b / t) AS BIGINT) AS depth, CAST(n - floor(n * a / t) - floor(n * b / t) AS BIGINT) AS joint FROM (SELECT *, CASE WHEN a + b + c > 0 THEN a + b + c ELSE 1e0 END AS t FROM (SELECT event_id, user_id AS n, greatest(0e0, value - 20) AS a, greatest(0e0, 40 - value) AS b, greatest(0e0, value - 50) AS c FROM events))")
def split_quota(s, d):
    v = F.col("value")
    return table(s, d, "events").select("event_id", sampling.split_columns(F.col("user_id"), v - 20, 40 - v, v - 50).alias("q")).select("event_id", "q.*")


@query("SELECT user_id, round(1 / (1 + 0.5 * count(*)), 6) AS weight FROM events GROUP BY user_id")
def inverse_frequency(s, d):
    return table(s, d, "events").groupBy("user_id").agg(F.round(sampling.weight("inverse_frequency", F.count("*"), 0.5), 6).alias("weight"))


@query("WITH RECURSIVE p AS (SELECT id, [label] AS path, level FROM kg_nodes WHERE level = 0 UNION ALL SELECT n.id, list_append(p.path, n.label), n.level FROM p JOIN kg_edges e ON e.parent = p.id AND e.relation = 'is_subconcept' JOIN kg_nodes n ON n.id = e.child) SELECT bundle_id, intent, max(p.level) AS level, string_agg(concat(p.id, '=', array_to_string(p.path, '>')), ';' ORDER BY p.id) AS paths FROM (SELECT bundle_id, intent, unnest(nodes) AS id FROM bundles) b JOIN p USING (id) GROUP BY bundle_id, intent")
def bundle_assembly(s, d):
    nodes = derived(s, d, "kg_nodes")
    paths = graph.ancestor_paths(nodes.withColumn("status", F.lit("expanding")), derived(s, d, "kg_edges"))
    out = sampling.assemble(derived(s, d, "bundles"), nodes, paths)
    text = F.array_join(F.transform(F.map_entries("ancestor_paths"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], ">"))), ";")
    return out.select("bundle_id", "intent", "level", text.alias("paths"))


_U = "((CAST(concat('0x', substr(md5(concat('{}|', {})), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496e0)"


@query(f"WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 1 / (1 + 1e0 * coalesce(n, 0)) AS w FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL) ON o_custkey = c_custkey), p AS (SELECT id, 1 AS pick, {_U.format(42, 'id')} AS ord FROM c UNION ALL SELECT id, 2, 1 - ln({_U.format(42, chr(99) + 'oncat(id, ' + chr(39) + '|1' + chr(39) + ')')}) / w FROM c) SELECT id, CAST(pick AS INTEGER) AS pick, round(ord, 9) AS ord FROM p ORDER BY p.ord, id, pick LIMIT 2000")
def weighted_draw(s, d):
    pool = table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    sampled = table(s, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.count("*").alias("times_sampled"))
    return sampling.draw(pool, sampled, 2000, seed=42, cap=2).withColumn("ord", F.round("ord", 9))


@query()
def joint_draw(s, d):
    nodes, edges = derived(s, d, "kg_nodes"), derived(s, d, "kg_edges")
    sampled = nodes.select("id", F.lit(1).alias("times_sampled"))
    return sampling.draw_groups(sampling.joint_pool(nodes, edges, 3), sampled, 40, seed=7, cap=2).select(F.array_join("members", "|").alias("members"))


@query("WITH q AS (SELECT o_orderkey AS id, o_custkey % 7 AS seed, length(o_orderpriority) AS level, o_orderkey AS seq FROM orders), t AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY level DESC, seq) AS t, min(seq) OVER (PARTITION BY seed) AS b FROM q) SELECT id, row_number() OVER (ORDER BY t, b) AS pos FROM t")
def frontier_order(s, d):
    q = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 7).alias("seed"), F.length("o_orderpriority").alias("level"), F.col("o_orderkey").alias("seq"))
    return sampling.frontier_order(q, "balanced").select("id", F.col("pos").cast("long").alias("pos"))


@query("SELECT s_suppkey, (s_nationkey % 8 >= 6) OR (s_suppkey % 9 >= 5 AND (s_acctbal < 0 OR s_acctbal / 10000 >= 0.7)) AS atomic FROM supplier")
def atomicity(s, d):
    rate = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 10000)
    return table(s, d, "supplier").select("s_suppkey", sampling.is_atomic(F.col("s_nationkey") % 8, F.col("s_suppkey") % 9, rate, F.lit(None).cast("double")).alias("atomic"))


# retrieval


@query("SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, c AS text FROM (SELECT doc_id, i, trim(regexp_replace(substr(text, i * 700 + 1, 800), '^\\s+|\\s+$', '', 'g')) AS c FROM (SELECT doc_id, text, unnest(range(0, 1 + greatest(0, CAST(ceil((length(text) - 800) / 700.0) AS BIGINT)))) AS i FROM documents)) WHERE c <> ''")
def chunk_documents(s, d):
    return retrieval.chunk_rows(table(s, d, "documents"))


_POSTED = "WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY ALL), idf AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY term), nm AS (SELECT doc_id, sqrt(sum(((1 + ln(tf)) * idf) ** 2)) AS norm FROM tf JOIN idf USING (term) GROUP BY doc_id) "


@query(_POSTED + "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_tokens, count(*) AS n_terms FROM tf GROUP BY doc_id")
def tokenize_counts(s, d):
    return retrieval.postings(table(s, d, "documents"), "doc_id").groupBy("doc_id").agg(F.sum("tf").alias("n_tokens"), F.count("*").alias("n_terms"))


@query(_POSTED + "SELECT term, df, round(idf, 6) AS idf FROM idf")
def idf_table(s, d):
    docs = table(s, d, "documents")
    return retrieval.inverse_frequencies(retrieval.postings(docs, "doc_id"), docs.count()).withColumn("idf", F.round("idf", 6))


@query(_POSTED + "SELECT doc_id, round(norm, 6) AS norm FROM nm")
def chunk_norms(s, d):
    docs = table(s, d, "documents")
    posted = retrieval.postings(docs, "doc_id")
    return retrieval.norms(posted, retrieval.inverse_frequencies(posted, docs.count()), "doc_id").withColumn("norm", F.round("norm", 6))


@query(_POSTED + ", q AS (SELECT qid, term, count(*) AS c FROM (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL), qw AS (SELECT qid, term, (1 + ln(c)) * coalesce(idf, 0) AS w FROM q LEFT JOIN idf USING (term)), qn AS (SELECT qid, sqrt(sum(w * w)) AS qnorm FROM qw GROUP BY qid), sc AS (SELECT qid, doc_id, round(sum(w * (1 + ln(tf)) * idf) / (any_value(qnorm) * any_value(norm)), 9) AS score FROM qw JOIN tf USING (term) JOIN idf USING (term) JOIN nm USING (doc_id) JOIN qn USING (qid) GROUP BY qid, doc_id) SELECT qid, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= 8")
def tfidf_topk(s, d):
    return retrieval.tfidf_search(table(s, d, "documents"), table(s, d, "benchmark").select(F.col("item_id").alias("qid"), "text"), 8, "doc_id").withColumn("score", F.round("score", 6))


@query("""WITH t AS (SELECT n_name AS label, r_name AS top FROM nation JOIN region ON r_regionkey = n_regionkey)
SELECT label, 'web' AS source_type, concat(top, ' deep one ', label, '|', top, ' deep one ', label, ' tutorial|', label, ' in deep one guide') AS queries FROM (SELECT label, 'x' AS top FROM t)
UNION ALL SELECT label, 'github', concat('root ', top, ' ', label, '|', label, ' topic:', lower(replace(top, ' ', '-'))) FROM t
UNION ALL SELECT label, 'github', concat(label, '|', label, ' topic:', lower(replace(label, ' ', '-'))) FROM t
UNION ALL SELECT label, 'arxiv', concat('"root ', top, ' ', label, '"') FROM t
UNION ALL SELECT label, 'local', concat('root ', top, ' ', label, '|', label, ' AND x') FROM t""")
def query_shapes(s, d):
    own = table(s, d, "nation").join(table(s, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    own = own.select(F.col("n_name").alias("label"), F.array(F.lit(" root"), "r_name", F.lit(" "), F.lower("n_name")).alias("path"))
    none = F.array().cast("array<string>")
    shape = lambda source, path=F.col("path"), others=none: own.select("label", path.alias("path"), F.lit(source).alias("source_type"), others.alias("others"))
    every = shape("web", F.array(F.lit("top"), F.lit("x"), F.lit("deep one"))).unionByName(shape("github")).unionByName(shape("github", none)).unionByName(shape("arxiv"))
    every = every.unionByName(shape("local", others=F.array("label", F.lit(" x "), F.lit(""), F.lit("x"))))
    return retrieval.query_shapes(every).withColumn("queries", F.array_join("queries", "|"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN concat(event_type, chr(10), 'last') WHEN 2 THEN concat('x', chr(10), event_type) ELSE event_type END AS text FROM events WHERE event_id % 5 <> 3")
def record_texts(s, d):
    """Fields by path, objects in order of names, arrays, and records without text."""
    spec = ExtractionSpec("jsonl", ("body", "meta.items.1", "meta.list"), "pages")
    kind = F.col("event_id") % 5
    body = lambda text: F.format_string(text, "event_type")
    raw = F.when(kind == 0, body('{"body": " %s\\n"}')).when(kind == 1, body('{"body": "", "pages": {"2": "last", "1": "%s", "3": 4}}')).when(kind == 2, body('{"meta": {"list": ["x", "", "%s"]}}')).when(kind == 3, F.col("props")).otherwise(body('{"body": 5, "meta": {"items": [0, "%s"]}}'))
    return table(s, d, "events").select("event_id", record_text(F.try_parse_json(raw), spec).alias("text")).where("text is not null")


@query("SELECT b.bundle_id, i AS id, CAST(p - 1 AS INTEGER) AS pos, coalesce(n.label, i) AS label, CASE WHEN p = 1 THEN 'top' ELSE '' END AS path, CASE WHEN intent = 'joint' THEN (SELECT string_agg(coalesce(m.label, x), '|' ORDER BY q) FROM (SELECT unnest(b.nodes) AS x, unnest(range(1, 3)) AS q) LEFT JOIN kg_nodes m ON m.id = x) ELSE '' END AS others FROM (SELECT bundle_id, intent, nodes, unnest(nodes) AS i, unnest(range(1, 3)) AS p FROM bundles) b LEFT JOIN kg_nodes n ON n.id = i")
def retrieval_targets(s, d):
    """The labels of bundles' nodes; some are unknown, and some have no path."""
    own = derived(s, d, "bundles").withColumn("ancestor_paths", F.create_map(F.col("nodes")[0], F.array(F.lit("top"))))
    return targets(own, derived(s, d, "kg_nodes")).withColumns({"path": F.array_join("path", "|"), "others": F.array_join("others", "|")})


@query("SELECT material_id FROM materials WHERE source_type <> 'web' OR coalesce(nullif(lower(license), ''), 'unknown') IN ('unknown', 'cc-by', 'cc0', 'public-domain', 'mit', 'apache-2.0')")
def license_filter(s, d):
    return retrieval.licensed(derived(s, d, "materials")).select("material_id")


_NORMAL = r"""WITH u AS (SELECT page_id, regexp_extract(trim(url), '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?', ['scheme', 'host', 'path', 'query']) AS m FROM pages),
n AS (SELECT page_id, concat(CASE WHEN m.scheme <> '' THEN concat(lower(m.scheme), ':') ELSE '' END, lower(m.host), rtrim(m.path, '/'), CASE WHEN q <> '' THEN concat('?', q) ELSE '' END) AS url
 FROM (SELECT page_id, m, array_to_string(list_transform(list_filter(string_split(m.query, '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')), lambda x: CASE WHEN contains(x, '=') THEN x ELSE concat(x, '=') END), '&') AS q FROM u)) """


@query(_NORMAL + "SELECT min(page_id) AS page_id, url FROM n GROUP BY url")
def url_dedup(s, d):
    own = table(s, d, "pages").select("page_id", T.normal_url("url").alias("url"))
    return retrieval.first_of(own, F.col("url"), "page_id")


@query(_NORMAL + "SELECT page_id, url FROM n")
def url_normalize(s, d):
    return table(s, d, "pages").select("page_id", T.normal_url("url").alias("url"))


_PRINTS = """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), g AS (SELECT doc_id, unnest(CASE WHEN len(w) < 4 THEN w ELSE [concat_ws(' ', w[i], w[i + 1], w[i + 2]) for i in range(1, len(w) - 1)] END) AS g FROM t),
h AS (SELECT doc_id, CAST(concat('0x', substr(md5(g), 1, 8)) AS BIGINT) AS hi, CAST(concat('0x', substr(md5(g), 9, 8)) AS BIGINT) AS lo FROM g), s AS (SELECT doc_id, b, 2 * sum((hi >> b) & 1) > count(*) AS hi, 2 * sum((lo >> b) & 1) > count(*) AS lo FROM h, (SELECT unnest(range(32)) AS b) GROUP BY doc_id, b),
p AS (SELECT doc_id, CAST(sum(CASE WHEN hi THEN CAST(1 AS BIGINT) << b ELSE 0 END) AS BIGINT) AS hi, CAST(sum(CASE WHEN lo THEN CAST(1 AS BIGINT) << b ELSE 0 END) AS BIGINT) AS lo FROM s GROUP BY doc_id),
f AS (SELECT doc_id, coalesce((CASE WHEN hi >= 2147483648 THEN hi - 4294967296 ELSE hi END) * 4294967296 + lo, 0) AS fp FROM documents LEFT JOIN p USING (doc_id))"""


@query(_PRINTS + " SELECT doc_id, fp FROM f")
def simhash_values(s, d):
    return table(s, d, "documents").select("doc_id", T.simhash64("text").alias("fp"))


_SIGNS = "list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS BIGINT) << (i - {0}) ELSE 0 END for i in range({0}, {0} + 32)])"


@query(f"WITH p AS (SELECT vec_id AS id, {_SIGNS.format(1)} AS lo, {_SIGNS.format(33)} AS hi FROM embeddings), f AS (SELECT min(id) AS id, lo, hi FROM p GROUP BY lo, hi), e AS (SELECT a.id AS a, b.id AS b, bit_count(xor(CAST(a.lo AS BIGINT), CAST(b.lo AS BIGINT))) + bit_count(xor(CAST(a.hi AS BIGINT), CAST(b.hi AS BIGINT))) AS d FROM f a JOIN f b ON a.id < b.id) SELECT a, b, CAST(d AS INTEGER) AS d FROM e WHERE d <= 3")
def hamming_pairs(s, d):
    """The signs of all 64 components."""
    bits = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return retrieval.near_pairs(table(s, d, "embeddings").select(F.col("vec_id").alias("id"), bits.alias("fp")))


@query(_NORMAL + "SELECT page_id, bundle_id FROM (SELECT n.page_id, concat('b', p.page_id % 10) AS bundle_id, row_number() OVER (PARTITION BY p.page_id % 10, n.url ORDER BY p.page_id) AS r FROM n JOIN pages p ON p.page_id = n.page_id) WHERE r = 1")
def dedup_in_bundles(s, d):
    own = table(s, d, "pages").select("page_id", F.col("page_id").alias("ord"), F.concat(F.lit("b"), F.col("page_id") % 10).alias("bundle_id"), F.col("url").alias("uri"), F.lit(None).cast("string").alias("path"), F.col("page_id").cast("string").alias("material_id"))
    return retrieval.deduplicated(own, "url").select("page_id", "bundle_id")


@query("WITH RECURSIVE " + _PRINTS[5:] + """, o AS (SELECT doc_id AS id, fp, row_number() OVER (ORDER BY doc_id) AS r FROM f),
k AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS kept, false AS took UNION ALL SELECT o.r, CASE WHEN near THEN kept ELSE list_append(kept, fp) END, NOT near FROM (SELECT o.r, o.fp, k.kept, len(list_filter(k.kept, lambda x: bit_count(xor(x, o.fp)) <= 3)) > 0 AS near FROM k JOIN o ON o.r = k.r + 1) o)
SELECT id FROM k JOIN o USING (r) WHERE took""")
def simhash_dedup(s, d):
    prints = table(s, d, "documents").select(F.col("doc_id").alias("id"), T.simhash64("text").alias("fp"))
    return retrieval.keep_first_near(prints)


@query("SELECT m.material_id, round(len(list_intersect(list_distinct(regexp_extract_all(lower(concat_ws(' ', m.title, m.snippet, m.text)), '[a-z0-9]+')), q)) / len(q), 6) AS score FROM materials m, (SELECT list_distinct(regexp_extract_all(lower(string_agg(text, ' ' ORDER BY item_id)), '[a-z0-9]+')) AS q FROM benchmark)")
def rerank_overlap(s, d):
    """The whole benchmark as the description."""
    asked = table(s, d, "benchmark").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "text"))), lambda x: x["text"]), " ").alias("asked"))
    asked = asked.select(retrieval.asked_tokens(F.col("asked")).alias("asked"))
    own = derived(s, d, "materials").crossJoin(F.broadcast(asked))  # one row
    return retrieval.rerank(own, F.col("asked")).select("material_id", F.round("score", 6).alias("score"))


@query("WITH h AS (SELECT k, id, b, count(*) AS n FROM (SELECT k, id, CAST(concat('0x', substr(md5(t), 1, 8)) AS BIGINT) % 256 AS b FROM (SELECT 'c' AS k, concat('i', item_id) AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM benchmark UNION ALL SELECT 'k', id, unnest(regexp_extract_all(lower(label), '[a-z0-9]+')) FROM kg_nodes)) GROUP BY ALL), w AS (SELECT k, id, b, n / sqrt(sum(n * n) OVER (PARTITION BY k, id)) AS w FROM h), m AS (SELECT c.id AS cand, k.id, round(sum(c.w * k.w), 9) AS sim FROM w c JOIN w k ON c.b = k.b AND c.k = 'c' AND k.k = 'k' GROUP BY c.id, k.id) SELECT cand, id, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY sim DESC, id) AS rank FROM m) WHERE rank <= 8")
def align_recall_topk(s, d):
    return retrieval.recall(table(s, d, "benchmark").select(F.concat(F.lit("i"), "item_id").alias("cand"), "text"), derived(s, d, "kg_nodes").select("id", F.col("label").alias("text"))).withColumn("sim", F.round("sim", 6))


@query("SELECT DISTINCT bundle_id, material_id FROM (SELECT bundle_id, unnest(nodes) AS id FROM bundles) JOIN (SELECT material_id, unnest(linked_nodes) AS id FROM materials) USING (id)")
def bundle_material_join(s, d):
    return retrieval.link_materials(derived(s, d, "bundles"), derived(s, d, "materials"))


@query("WITH c AS (SELECT id AS i, count(DISTINCT material_id) AS n FROM (SELECT material_id, unnest(linked_nodes) AS id FROM materials) GROUP BY id) SELECT id, coalesce(n, n_materials) AS n_materials, CASE WHEN n IS NOT NULL AND status NOT IN ('merged', 'frozen') AND (level >= 6 OR n >= 5) THEN 'atomic' ELSE status END AS status FROM kg_nodes LEFT JOIN c ON i = id")
def material_writeback(s, d):
    nodes = derived(s, d, "kg_nodes").withColumns({"synth_success_rate": F.lit(None).cast("double"), "child_material_overlap": F.lit(None).cast("double")})
    return retrieval.material_counts(nodes, derived(s, d, "materials")).select("id", "n_materials", "status")


# tasks


@query("SELECT bundle_id FROM bundles WHERE bundle_id NOT IN (SELECT concat('b', o_custkey % 20) FROM orders)")
def resume_antijoin(s, d):
    done = table(s, d, "orders").select(F.concat(F.lit("b"), F.col("o_custkey") % 20).alias("bundle_id"))
    return derived(s, d, "bundles").join(done, "bundle_id", "left_anti").select("bundle_id")


@query(f"SELECT bundle_id, CASE WHEN intent = 'joint' THEN 'multihop_qa' ELSE ['atomic_qa', 'aggregated_qa', 'multihop_qa', 'grounded_summary', 'comparative_analysis'][1 + CAST(floor(5 * {_U.format(42, 'bundle_id')}) AS BIGINT)] END AS task_type FROM bundles")
def type_pick(s, d):
    return derived(s, d, "bundles").select("bundle_id", tasks.pick_type(F.col("intent"), F.col("bundle_id"), [t for t, _, _ in tasks.TASK_TYPES]).alias("task_type"))


@query("WITH l AS (SELECT bundle_id, count(DISTINCT material_id) AS n FROM (SELECT bundle_id, unnest(nodes) AS id FROM bundles) JOIN (SELECT material_id, unnest(linked_nodes) AS id FROM materials) USING (id) GROUP BY bundle_id) SELECT b.bundle_id, task_type, coalesce(n, 0) AS n_materials, coalesce(n, 0) >= CASE WHEN task_type = 'multihop_qa' THEN 2 ELSE 1 END AS enough FROM (SELECT bundle_id, CASE WHEN intent = 'joint' THEN 'multihop_qa' ELSE 'atomic_qa' END AS task_type FROM bundles UNION ALL SELECT concat('o', o_orderkey), CASE WHEN o_orderkey % 2 = 0 THEN 'multihop_qa' ELSE 'atomic_qa' END FROM orders) b LEFT JOIN (SELECT * FROM l UNION ALL SELECT concat('o', l_orderkey), count(*) FROM lineitem GROUP BY l_orderkey) USING (bundle_id)")
def min_docs_gate(s, d):
    """All materials; orders with their lines are bundles too, of which some have fewer than their type needs."""
    bundles, orders = derived(s, d, "bundles"), table(s, d, "orders")
    linked = retrieval.link_materials(bundles, derived(s, d, "materials"))
    linked = linked.unionByName(table(s, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("bundle_id"), F.lit("line").alias("material_id")))
    typed = bundles.select("bundle_id", F.when(F.col("intent") == "joint", "multihop_qa").otherwise("atomic_qa").alias("task_type"))
    own = orders.select(F.concat(F.lit("o"), "o_orderkey").alias("bundle_id"), F.when(F.col("o_orderkey") % 2 == 0, "multihop_qa").otherwise("atomic_qa").alias("task_type"))
    return tasks.gate(typed.unionByName(own), linked, tasks.task_types(s)).select("bundle_id", "task_type", "n_materials", "enough")


@query("SELECT bundle_id, CASE WHEN n_nationkey % 3 = 0 THEN '根据现有检索到的材料，信息不足，无法可靠回答该问题。' ELSE 'The retrieved materials do not contain enough information to answer this question reliably.' END AS answer FROM (SELECT bundle_id, n_nationkey FROM bundles JOIN nation ON bundle_id = concat('b', n_nationkey))")
def reject_answers(s, d):
    return derived(s, d, "bundles").select("bundle_id", tasks.reject_answer(F.when(F.col("intent") == "joint", "zh").otherwise("zh-CN")).alias("answer"))


@query("SELECT bundle_id, CASE WHEN intent = 'joint' THEN concat('请介绍：', array_to_string(nodes, '、'), '。') ELSE concat('Explain: ', array_to_string(nodes, ', '), '.') END AS question FROM bundles")
def reject_sample(s, d):
    return derived(s, d, "bundles").select("bundle_id", tasks.reject_task(F.col("nodes"), F.when(F.col("intent") == "joint", "zh").otherwise("en")).alias("question"))


_FORM = "trim(regexp_replace(lower({}), '[\\s_\\x21-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7e]+', ' ', 'g'))"


@query(f"WITH c AS (SELECT task_id, CAST(len(list_filter(materials, lambda m: contains({_FORM.format('answer')}, {_FORM.format('m')}))) AS INTEGER) AS n FROM tasks) SELECT task_id, CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END AS result, CASE WHEN n > 0 THEN 1e0 ELSE 0e0 END AS score, n AS cited FROM c")
def answer_match(s, d):
    return derived(s, d, "tasks").select("task_id", tasks.answer_match(F.col("answer"), F.col("materials")).alias("r")).select("task_id", "r.*")


@query("SELECT user_id, CASE WHEN avg(value / 100) >= 0.5 AND count(*) = count(value) THEN 'pass' ELSE 'fail' END AS result FROM events GROUP BY user_id")
def rubric_mean(s, d):
    # collect_list leaves nulls out, but not structs of them
    own = table(s, d, "events").groupBy("user_id").agg(F.collect_list(F.struct((F.col("value") / 100).alias("v")))["v"].alias("scores"))
    return own.select("user_id", tasks.rubric_mean(F.col("scores"), 0.5)["result"].alias("result"))


@query("SELECT task_id, CASE WHEN verify_result = 'sft_only' OR verifier IS NULL THEN NULL WHEN verifier = 'answer_match' THEN verifier ELSE 'rubric_judge' END AS by FROM tasks")
def verify_dispatch(s, d):
    return derived(s, d, "tasks").select("task_id", tasks.dispatch(F.col("verify_result"), F.col("verifier")).alias("by"))


_CONTEXT = """WITH c AS (SELECT task_id, language, m.material_id, m.title, i, regexp_replace(coalesce(nullif(m.text, ''), m.snippet), '^\\s+|\\s+$', '', 'g') AS body FROM (SELECT task_id, language, unnest(materials) AS id, unnest(range(1, 4)) AS i FROM tasks) JOIN materials m ON m.material_id = id WHERE m.quality_score >= 0.1 AND regexp_matches(coalesce(nullif(m.text, ''), m.snippet), '\\S')),
b AS (SELECT *, 4000 - coalesce(sum(length(body)) OVER (PARTITION BY task_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM c),
x AS (SELECT task_id, concat(CASE WHEN lower(any_value(language)) LIKE 'zh%' THEN '材料：' ELSE 'Materials:' END, chr(10), string_agg(regexp_replace(concat('[', material_id, '] ', title, chr(10), left(body, CAST(room AS BIGINT))), '^\\s+|\\s+$', '', 'g'), concat(chr(10), chr(10)) ORDER BY i), chr(10), chr(10), CASE WHEN lower(any_value(language)) LIKE 'zh%' THEN '问题：' ELSE 'Question：' END) AS context FROM b WHERE room > 0 GROUP BY task_id) """


@query(_CONTEXT + "SELECT task_id, coalesce(context, '') AS context FROM tasks LEFT JOIN x USING (task_id)")
def context_block(s, d):
    return tasks.context_blocks(derived(s, d, "tasks"), derived(s, d, "materials"), 4000, 0.1)


@query("SELECT task_id FROM tasks t WHERE EXISTS (SELECT 1 FROM materials m WHERE list_contains(t.materials, m.material_id) AND m.quality_score >= 0.4)")
def grounding_gate(s, d):
    return tasks.grounded(derived(s, d, "tasks"), derived(s, d, "materials"), 0.4).select("task_id")


@query(_CONTEXT + "SELECT task_id, md5(concat(coalesce(context, ''), question, '|', answer)) AS pair FROM tasks LEFT JOIN x USING (task_id) WHERE verify_result IN ('pass', 'sft_only')")
def sft_export(s, d):
    own = derived(s, d, "tasks")
    lines = tasks.export_sft(own, tasks.context_blocks(own, derived(s, d, "materials"), 4000, 0.1))
    row = F.from_json("line", "messages array<struct<role:string,content:string>>, task_id string")
    return lines.select(row["task_id"].alias("task_id"), F.md5(F.concat(row["messages"][0]["content"], F.lit("|"), row["messages"][1]["content"]).cast("binary")).alias("pair"))


@query("SELECT task_id, verifier, question AS prompt FROM tasks WHERE verify_result = 'pass' AND verifier IS NOT NULL")
def rl_export(s, d):
    own = derived(s, d, "tasks").withColumn("rubric", F.array(F.lit("correct")))
    lines = tasks.export_rl(own, tasks.context_blocks(own, derived(s, d, "materials")))
    row = F.from_json("line", "task_id string, verifier string, prompt string")
    return lines.select(row["task_id"].alias("task_id"), row["verifier"].alias("verifier"), row["prompt"].alias("prompt"))


@query("SELECT 'task_type' AS kind, task_type AS value, count(*) AS n FROM tasks GROUP BY ALL UNION ALL SELECT 'verify_result', verify_result, count(*) FROM tasks GROUP BY ALL UNION ALL SELECT 'source_type', source_type, count(*) FROM materials GROUP BY ALL")
def manifest_counts(s, d):
    return tasks.manifest(derived(s, d, "tasks"), derived(s, d, "materials"))


@query("SELECT task_id, concat(task_id, ' [', task_type, '/', verify_result, '] ', left(question, 36)) AS label FROM tasks WHERE task_type = 'multihop_qa' AND verify_result = 'pass'")
def task_labels(s, d):
    return tasks.labels_of(tasks.chosen(derived(s, d, "tasks"), "multihop_qa", "pass"))


@query("SELECT task_id, md5(concat('### ', task_type, ' · ', verify_result, chr(10), chr(10), '**Q** ', question, chr(10), chr(10), '**A** ', answer, chr(10), chr(10), '**rubric**', chr(10), '- ', level, chr(10), '- ', language)) AS text, concat('{\"task_id\":\"', task_id, '\",\"verifier\":', CASE WHEN verifier IS NULL THEN 'null' ELSE concat('\"', verifier, '\"') END, ',\"materials\":[\"', array_to_string(materials, '\",\"'), '\"],\"nodes\":[\"', array_to_string(nodes, '\",\"'), '\"]}') AS provenance FROM tasks")
def task_detail(s, d):
    own = derived(s, d, "tasks").withColumn("rubric", F.array(F.col("level").cast("string"), "language"))
    return tasks.detail(own).withColumn("text", F.md5(F.col("text").cast("binary")))


@query("SELECT task_id, concat('{\"task_id\":\"', task_id, '\",\"task_type\":\"', task_type, '\",\"nodes\":[\"', array_to_string(nodes, '\",\"'), '\"],\"ancestor_paths\":', CASE WHEN b.n IS NULL THEN 'null' ELSE concat('{\"x\":[\"', b.n, '\"]}') END, ',\"material_ids\":[\"', array_to_string(materials, '\",\"'), '\"],\"verifier\":', CASE WHEN verifier IS NULL THEN 'null' ELSE concat('\"', verifier, '\"') END, ',\"verify_result\":\"', verify_result, '\"}') AS line FROM tasks LEFT JOIN (SELECT bundle_id AS n FROM bundles) b ON b.n = concat('b', level)")
def task_lineage(s, d):
    own = derived(s, d, "tasks").withColumn("bundle_id", F.concat(F.lit("b"), "level"))
    paths = derived(s, d, "bundles").select("bundle_id", F.create_map(F.lit("x"), F.array("bundle_id")).alias("ancestor_paths"))
    return tasks.lineage(own, paths)


# reports


@query("WITH h AS (SELECT DISTINCT unnest(nodes) AS i FROM tasks) SELECT level, count(*) AS n_nodes, count(i) AS n_sampled, count(*) FILTER (status = 'atomic') AS n_atomic, count(*) FILTER (status = 'atomic' AND i IS NULL) AS n_atomic_unsampled FROM kg_nodes LEFT JOIN h ON i = id WHERE status <> 'merged' GROUP BY level")
def coverage(s, d):
    return report.coverage(derived(s, d, "kg_nodes"), derived(s, d, "tasks"))


@query("WITH h AS (SELECT DISTINCT unnest(nodes) AS i FROM tasks) SELECT coalesce(count(*) FILTER (i IS NULL) / nullif(count(*), 0), 0e0) AS long_tail_ratio FROM kg_nodes LEFT JOIN h ON i = id WHERE status = 'atomic'")
def long_tail(s, d):
    return report.long_tail(derived(s, d, "kg_nodes"), derived(s, d, "tasks"))


@query("WITH w AS (SELECT task_id, list_filter(regexp_split_to_array(lower(question), '\\s+'), lambda x: x <> '') AS w FROM tasks), g AS (SELECT task_id, list_distinct(CASE WHEN len(w) < 3 THEN w ELSE [concat_ws(' ', w[i], w[i + 1], w[i + 2]) for i in range(1, len(w) - 1)] END) AS g FROM w) SELECT round(coalesce(avg(CASE WHEN len(a.g) + len(b.g) = 0 THEN 0 ELSE len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) END), 0), 6) AS jaccard_mean FROM g a JOIN g b ON a.task_id < b.task_id")
def jaccard_mean(s, d):
    return report.jaccard_mean(derived(s, d, "tasks"))


@query("WITH u AS (SELECT m, count(DISTINCT task_id) AS n FROM (SELECT task_id, unnest(materials) AS m FROM tasks) GROUP BY m) SELECT count(*) AS n_used, count(*) FILTER (n > 1) AS n_reused, round(count(*) FILTER (n > 1) / count(*), 6) AS reuse_rate FROM u")
def material_reuse(s, d):
    return report.material_reuse(derived(s, d, "tasks"))


@query("SELECT task_type, level, count(*) AS n FROM tasks GROUP BY ALL")
def diversity_matrix(s, d):
    return report.diversity(derived(s, d, "tasks"))


@query("SELECT task_type, count(*) FILTER (verify_result = 'pass') AS n_pass, count(*) FILTER (verify_result = 'fail') AS n_fail, count(*) FILTER (verify_result = 'sft_only') AS n_sft_only, count(*) FILTER (verify_result = 'unverified') AS n_unverified FROM tasks GROUP BY ROLLUP (task_type)")
def quality_rollup(s, d):
    return report.quality(derived(s, d, "tasks"))


@query("SELECT task_id, NOT EXISTS (SELECT 1 FROM (SELECT unnest(t.materials) AS m) WHERE m NOT IN (SELECT material_id FROM materials)) AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(t.nodes) AS n) WHERE n NOT IN (SELECT id FROM kg_nodes)) AS ok FROM tasks t")
def provenance(s, d):
    return report.provenance(derived(s, d, "tasks"), derived(s, d, "materials"), derived(s, d, "kg_nodes"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def upsert_latest(s, d):
    return report.latest(table(s, d, "events"), "user_id", "event_id").select("user_id", "event_id", "event_type")


@query("WITH c AS (SELECT event_type AS run, event_id AS seq, user_id AS prompt, CAST(1 AS BIGINT) AS cost FROM events), h AS (SELECT *, row_number() OVER (PARTITION BY run, prompt ORDER BY seq) > 1 AS hit FROM c), b AS (SELECT *, coalesce(sum(CASE WHEN hit THEN 0 ELSE cost END) OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM h) SELECT run, seq, hit, hit OR spent < 50 AS allowed FROM b")
def llm_budget_window(s, d):
    calls = table(s, d, "events").select(F.col("event_type").alias("run"), F.col("event_id").alias("seq"), F.col("user_id").alias("prompt"), F.lit(1.0).alias("cost"))
    return report.budget(calls, 100, 50.0).select("run", "seq", "hit", "allowed")


@query("SELECT event_id, json_extract_string(props, '$') AS p FROM events WHERE props IS NULL UNION ALL SELECT event_id, props AS p FROM events WHERE props IS NOT NULL")
def extract_json(s, d):
    wrapped = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(F.concat(F.lit("Here it is: "), "props", F.lit(" Bye.")))
    return table(s, d, "events").select("event_id", T.json_part(wrapped).alias("p"))


@query("SELECT n_nationkey, concat('n_', lower(replace(n_name, ' ', '-')), '-', left(sha1(lower(n_name)), 8)) AS id FROM nation")
def node_ids(s, d):
    return table(s, d, "nation").select("n_nationkey", T.node_id(F.col("n_name")).alias("id"))


SQL = {name: _oracle(sql) for name, sql in _SQL.items()}
