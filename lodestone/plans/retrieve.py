"""The retrieval of materials for bundles: queries by source, searches, licences, duplicates, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators import retrieval
from lodestone.plans.durable import durable
from lodestone.sources.search import Fetch, answered, ask_service

NONE = "array<string>"


def targets(bundles: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bundle_id, id, pos, label, path, others): a row for each node of a bundle; unknown nodes go by their ids."""
    known = nodes.select("id", "label")
    one = bundles.select("bundle_id", "intent", F.posexplode("nodes").alias("pos", "id"), "ancestor_paths").join(known, "id", "left")
    one = one.withColumns({"label": F.coalesce("label", "id"), "path": F.coalesce(F.col("ancestor_paths")[F.col("id")], F.array().cast(NONE))})
    group = one.groupBy("bundle_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]).alias("group"))
    others = F.when(F.col("intent") == "joint", F.col("group")).otherwise(F.array().cast(NONE))
    return one.join(group, "bundle_id").withColumn("others", others).select("bundle_id", "id", "pos", "label", "path", "others")


def _local(asked: DataFrame, chunks: DataFrame, per_node: int) -> DataFrame:
    """All queries of a target are one bag of terms."""
    queries = asked.select(F.concat_ws("|", "bundle_id", "id").alias("qid"), F.array_join("queries", " ").alias("text"), "bundle_id", "id", "pos")
    best = retrieval.tfidf_search(chunks, queries.select("qid", "text"), per_node, "material_id")
    rows = best.join(queries.drop("text"), "qid").join(chunks, "material_id")
    return rows.select(
        "bundle_id", "id", "pos", F.lit("local").alias("source_type"), "material_id", F.lit(None).cast("string").alias("uri"), "path", F.element_at(F.split("path", "/"), -1).alias("title"), F.left("text", F.lit(200)).alias("snippet"), "text", F.lit(None).cast("string").alias("license"), F.col("score").alias("quality_score"), F.col("rank").cast("bigint").alias("at"),
    )


def _remote(asked: DataFrame, name: str, per_node: int, fetch: Fetch) -> DataFrame:
    requests = asked.select(F.to_json(F.struct("bundle_id", "id", "pos")).alias("request_id"), "queries", F.lit(per_node).alias("budget"))
    return ask_service(requests, name, fetch)


def retrieve_materials(bundles: DataFrame, nodes: DataFrame, chunks: DataFrame | None, settings: dict, fetch: Fetch) -> DataFrame:
    """Materials with linked_nodes. settings: sources, per_node, license, dedup, rerank. A source that fails is left out, unless all fail."""
    own = durable(targets(bundles, nodes), "targets")
    found, remote = None, None
    for name in settings["sources"]:
        asked = retrieval.query_shapes(own.withColumn("source_type", F.lit(name)))
        if name == "local":
            found = _local(asked, chunks, settings["per_node"])
        else:
            rows = _remote(asked, name, settings["per_node"], fetch)
            remote = rows if remote is None else remote.unionByName(rows)
    if remote is not None:
        remote = durable(remote, "replies")
        good = remote.where("ord >= 0").drop("error") if found is not None else answered(remote)
        at = F.from_json("request_id", "bundle_id string, id string, pos int")
        named = F.concat(F.lit("m_"), F.left(F.sha2(F.concat_ws("|", "source_type", F.coalesce("uri", F.lit("")), "title", "snippet"), 256), F.lit(16)))
        good = good.select(at.alias("t"), "*").select("t.bundle_id", "t.id", "t.pos", "source_type", named.alias("material_id"), "uri", F.lit(None).cast("string").alias("path"), "title", "snippet", F.lit("").alias("text"), "license", F.lit(0.0).alias("quality_score"), F.col("ord").alias("at"))
        found = good if found is None else found.unionByName(good)
    order = F.row_number().over(Window.partitionBy("bundle_id").orderBy("pos", F.array_position(F.array(*map(F.lit, settings["sources"])), F.col("source_type")), "at", "material_id"))
    found = durable(found.withColumn("ord", order), "found")
    kept = retrieval.deduplicated(retrieval.licensed(found, settings["license"]), settings["dedup"])
    if settings["rerank"] != "none":
        described = own.join(nodes.select("id", "description"), "id", "left").groupBy("bundle_id").agg(F.array_join(F.collect_list(F.coalesce("description", F.lit(""))), " ").alias("asked"))
        described = described.withColumn("asked", retrieval.asked_tokens(F.col("asked")))
        kept = retrieval.rerank(kept.join(described, "bundle_id"), F.col("asked")).drop("asked")
        kept = kept.withColumn("quality_score", F.greatest("quality_score", "score")).drop("score")
    first = F.struct("bundle_id", "ord")
    columns = ("source_type", "uri", "path", "title", "snippet", "text", "license")
    return kept.groupBy("material_id").agg(*[F.min_by(c, first).alias(c) for c in columns], F.max("quality_score").alias("quality_score"), F.array_sort(F.collect_set("id")).alias("linked_nodes"))
