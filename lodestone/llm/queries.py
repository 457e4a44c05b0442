"""Queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bitpack, decontaminate, embed_dedup, html_extract, packing, pii, quality, sharding, simhash, suffix_lm
from lodestone.llm.common import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.span_digest(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", "n_spans", "n_secret", "secrets")


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.token_round_trip(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2, vocabulary=49_408)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/op4-{uuid.uuid4().hex}"
    written = sharding.write_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    text = F.coalesce("text", F.lit(""))
    rows = written.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "bucket", "place", "grown_shard",
    )
    return sharding.shard_slots(rows).drop("bucket", "place")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_extract.extract_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_links(_table(spark, sf_dir, "embeddings"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score_texts(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality.score_quality(docs, _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= quality.CUT).cast("int").alias("predicted"))


#: In DuckDB's SQL, for the operators that it can express.
SQL: dict[str, str] = {
    "op7_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
    "op8_embeddings": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.m, vec_id) AS component_id, vec_id = coalesce(c.m, vec_id) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_pii, op3_token_ids, op4_sharding, op5_simhash, op6_main_text, op7_decontamination, op8_embeddings, op9_lm_scores, op10_quality)
}
