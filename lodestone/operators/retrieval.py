"""Retrieval of materials: chunks, TF-IDF search, licence filter, duplicates, overlap ranking, query shapes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestone.functions.blocks import BestMatches
from lodestone.functions.text import chunks, hamming, normal_url, simhash64, strip, tokens
from lodestone.plans.durable import durable

#: Terms of queries that go to the tasks at once: some 50 MB.
QUERY_TERMS = 1_000_000

#: Licences of web materials that may be used.
FREE = ("unknown", "cc-by", "cc0", "public-domain", "mit", "apache-2.0")


def chunk_rows(docs: DataFrame, size: int = 800, overlap: int = 100, key: str = "doc_id") -> DataFrame:
    """(key, chunk_no, text)"""
    return docs.select(key, F.posexplode(chunks(F.coalesce("text", F.lit("")), size, overlap)).alias("chunk_no", "text"))


def postings(texts: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(key, term, tf). The terms of a text are counted in its row, so a task's memory is that of a text; only rows of repeated keys are added up.

    Texts are dealt by their keys, for as many tasks as there are cores.
    """
    own = texts.select(key, "text").repartition(key)
    repeated = durable(texts.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(key).alias("_again")), "repeated-keys")
    if repeated.isEmpty():
        return _counted(own, key)
    same = own[key].eqNullSafe(repeated["_again"])
    added = _counted(own.join(repeated, same, "left_semi"), key).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return _counted(own.join(repeated, same, "left_anti"), key).unionByName(added)


def _counted(texts: DataFrame, key: str) -> DataFrame:
    """(key, term, tf) of each row by itself: runs in its sorted terms."""
    own = texts.select(key, F.sort_array(tokens(F.col("text"))).alias("_t"))
    size, at = F.size("_t"), lambda i: F.get("_t", i)
    own = own.select(key, "_t", F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (at(i) != at(i - 1)))).alias("_first"))
    run = F.transform("_first", lambda i, k: F.struct(at(i).alias("term"), (F.coalesce(F.get("_first", k + 1), size) - i).cast("long").alias("tf")))
    return own.select(key, F.inline(run))


def inverse_frequencies(posted: DataFrame, n_chunks: int) -> DataFrame:
    """(term, df, idf)"""
    return posted.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log((max(n_chunks, 1) + 1) / (F.col("df") + 1)) + 1)


def norms(posted: DataFrame, idf: DataFrame, key: str = "chunk_id") -> DataFrame:
    w = (1 + F.log("tf")) * F.col("idf")
    return posted.join(idf, "term").groupBy(key).agg(F.sqrt(F.sum(w * w)).alias("norm"))


def _best(docs: DataFrame, key: str, asked: DataFrame, k: int, digits: int) -> DataFrame:
    """(qid, key, score, rank) from docs(key, ts array<struct<term,w>>, norm) and asked(qid, term, w) of unit length.

    The queries go to the tasks in blocks of at most QUERY_TERMS terms, which is checked by counting; a task keeps the best k rows of
    each query over all its rows, so what is shuffled is k rows a query and task, whatever the terms' frequencies.
    """
    sizes = durable(asked.groupBy("qid").agg(F.count("*").alias("n")), "query-sizes")
    blocks = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // QUERY_TERMS))
    asked = durable(asked.withColumn("_block", F.pmod(F.xxhash64("qid"), F.lit(blocks))), "queries")
    key_type, id_type = docs.schema[key].dataType, asked.schema["qid"].dataType
    kinds = [to_arrow_type(id_type), to_arrow_type(key_type), pa.float64()]
    out = None
    for block in range(blocks):
        own = asked.where(F.col("_block") == block).select("qid", "term", "w").toPandas()  # about QUERY_TERMS rows
        qids, terms = sorted(own["qid"].unique().tolist()), {t: i for i, t in enumerate(sorted(own["term"].unique().tolist()))}
        number = {x: i for i, x in enumerate(qids)}
        queries = (own["qid"].map(number).to_numpy(np.int64), own["term"].map(terms).to_numpy(np.int64), own["w"].to_numpy(np.float64))
        sent = docs.sparkSession.sparkContext.broadcast((queries, len(qids), pa.array(list(terms), to_arrow_type(asked.schema["term"].dataType))))

        def match(batches: Iterator[pa.RecordBatch], sent=sent, qids=qids) -> Iterator[pa.RecordBatch]:
            queries, n, known = sent.value
            best = BestMatches(queries, n, len(known), k, digits)
            for batch in batches:
                flat = batch.column("ts").flatten()
                code = pc.fill_null(pc.index_in(pc.struct_field(flat, "term"), known), -1).to_numpy()
                mine = code >= 0
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("ts")).to_numpy())
                sizes = np.bincount(row[mine], minlength=batch.num_rows)
                if batch.num_rows and n:
                    best.show(batch.column(key).to_pylist(), sizes, code[mine].astype(np.int64), pc.struct_field(flat, "w").to_numpy()[mine], batch.column("norm").to_numpy())
            q, keys, scores = best.found()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([qids[i] for i in q], keys, scores), kinds, strict=True)], names=["qid", key, "score"])

        found = docs.select(key, "ts", "norm").mapInArrow(match, f"qid {id_type.simpleString()}, {key} {key_type.simpleString()}, score double")
        out = found if out is None else out.unionByName(found)
    rank = Window.partitionBy("qid").orderBy(F.desc("score"), key)
    return out.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def tfidf_search(texts: DataFrame, queries: DataFrame, k: int, key: str = "chunk_id", digits: int = 9) -> DataFrame:
    """(qid, key, score, rank): the k best texts for each query (qid, text) by cosine; ties go to the smaller key.

    Scores that agree in `digits` digits are ties, as sums of the same terms may differ beyond. Only postings of query terms are gathered, a
    row for each text; norms need all postings of the texts.
    """
    posted = durable(postings(texts, key), "postings")  # used three times
    idf = durable(inverse_frequencies(posted, texts.count()), "idf")
    asked = queries.select("qid", F.explode(tokens(F.col("text"))).alias("term")).groupBy("qid", "term").agg(F.count("*").alias("c"))
    asked = asked.join(idf.select("term", "idf"), "term", "left").withColumn("w", (1 + F.log("c")) * F.coalesce("idf", F.lit(0.0)))
    length = asked.groupBy("qid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("qnorm"))
    asked = durable(asked.where("w > 0").join(length, "qid").select("qid", "term", (F.col("w") / F.col("qnorm")).alias("w")), "asked")
    weighed = posted.join(asked.select("term").distinct(), "term", "left_semi").join(idf.select("term", "idf"), "term")
    gathered = weighed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term", ((1 + F.log("tf")) * F.col("idf")).alias("w")))).alias("ts"))
    return _best(gathered.join(norms(posted, idf, key), key), key, asked, k, digits)


def query_shapes(targets: DataFrame) -> DataFrame:
    """targets(label, path, source_type, others) to (label, source_type, queries); `others` are the labels of a joint bundle, else empty."""
    name = strip(F.col("label"))
    above = F.filter(F.transform("path", strip), lambda x: (x != "") & (F.lower(x) != F.lower(name)))
    size = F.size(above)
    context = F.when(size > 2, F.slice(above, F.greatest(size - 1, F.lit(1)), 2)).otherwise(above)
    near = F.try_element_at(above, F.lit(-1))
    joined = lambda x: F.array_join(F.concat(x, F.array(name)), " ")
    topic = F.array_join(F.filter(F.split(F.lower(F.coalesce(near, name)), r"(?U)\s+"), lambda x: x != ""), "-")
    web = F.array(joined(context), F.concat(joined(context), F.lit(" tutorial")), F.when(near.isNotNull(), F.concat(name, F.lit(" in "), near, F.lit(" guide"))))
    shapes = (
        F.when(F.col("source_type") == "web", web)
        .when(F.col("source_type") == "github", F.array(joined(above), F.concat(name, F.lit(" topic:"), topic)))
        .when(F.col("source_type") == "arxiv", F.array(F.concat(F.lit('"'), joined(context), F.lit('"'))))
        .otherwise(F.array(joined(above)))
    )
    group = F.array_join(F.array_distinct(F.filter(F.transform("others", strip), lambda x: x != "")), " AND ")
    every = F.filter(F.concat(shapes, F.array(group)), lambda x: x.isNotNull() & (x != ""))
    return targets.withColumn("queries", every).drop("path", "others")


def licensed(materials: DataFrame, mode: str = "whitelist") -> DataFrame:
    if mode not in ("whitelist", "off"):
        raise ValueError(f"license filter must be whitelist or off, not {mode!r}")
    if mode == "off":
        return materials
    own = F.coalesce(F.nullif(F.lower("license"), F.lit("")), F.lit("unknown"))
    return materials.where((F.col("source_type") != "web") | own.isin(*FREE))


def first_of(materials: DataFrame, key: Column, order: str = "ord") -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(order))
    return materials.withColumn("_key", key).withColumn("_rank", rank).where("_rank = 1").drop("_key", "_rank")


def near_pairs(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b, d) of ids with a < b of fingerprints (id, fp) within the radius; of equal fingerprints the smallest id stands for all.

    The bits are cut into radius + 3 runs, of which at least three agree; each choice of three runs is a table with keys of some 32 bits.
    """
    runs = radius + 3
    edge = [64 * i // runs for i in range(runs + 1)]
    mask = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(runs)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    tables = [signed(sum(mask[i] for i in own)) for own in combinations(range(runs), 3)]
    band = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(tables)])).alias("band")
    one = prints.groupBy("fp").agg(F.min("id").alias("id")).select("id", "fp", band)
    other = one.select(F.col("id").alias("b"), F.col("fp").alias("g"), "band")
    # never by broadcast: sizes of tables are estimated without what explode makes of them
    near = one.select(F.col("id").alias("a"), "fp", "band").join(other.hint("merge"), "band").where("a < b").where(hamming(F.col("fp"), F.col("g")) <= radius)
    return near.select("a", "b", hamming(F.col("fp"), F.col("g")).alias("d")).distinct()


def keep_first_near(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Ids that a pass in order of id keeps: those within the radius of no kept smaller id. Equal fingerprints have one candidate."""
    nodes = durable(prints.groupBy("fp").agg(F.min("id").alias("id")), "prints")
    return _keep_first(nodes.select("id"), near_pairs(nodes, radius).select("a", "b"), "pairs")


def _keep_first(ids: DataFrame, pairs: DataFrame, tag: str) -> DataFrame:
    """Ids that a pass in order keeps, from pairs (a, b) of near ids with a < b.

    Each round decides the smallest open id at least, and all that no open smaller id is near to; rounds go on until no pair of open ids is
    left. All that a round joins comes from the pairs that are left, so ids that are near to none are only read once.
    """
    open_, kept, pairs = ids, None, durable(pairs, tag)
    while True:
        blocked = durable(pairs.select(F.col("b").alias("id")).distinct(), f"{tag}-blocked")
        now = open_.join(blocked, "id", "left_anti")
        kept = now if kept is None else kept.unionByName(now)
        if blocked.isEmpty():
            return kept
        gone = pairs.join(blocked.select(F.col("id").alias("a")), "a", "left_anti").select(F.col("b").alias("id")).distinct()
        open_ = durable(blocked.join(gone, "id", "left_anti"), f"{tag}-open")
        pairs = pairs.join(open_.select(F.col("id").alias("a")), "a", "left_semi").join(open_.select(F.col("id").alias("b")), "b", "left_semi")
        pairs = durable(pairs.select("a", "b"), tag)


def deduplicated(materials: DataFrame, mode: str = "simhash", *, by: str = "bundle_id", radius: int = 3) -> DataFrame:
    """Materials (uri, path, material_id, title, text, snippet, ord) without duplicates inside each `by`, the first by ord kept.

    url: by the normal form of the uri, else the path, else the id; simhash: by near fingerprints of title and text (else snippet); off or none: all.
    """
    if mode in ("off", "none"):
        return materials
    if mode == "url":
        name = F.coalesce(normal_url("uri"), F.concat(F.lit("path:"), F.nullif("path", F.lit(""))), F.concat(F.lit("id:"), "material_id"))
        return first_of(materials, F.struct(by, name), "ord")
    if mode != "simhash":
        raise ValueError(f"dedup must be url, simhash, off or none, not {mode!r}")
    text = F.concat_ws(" ", "title", F.coalesce(F.nullif("text", F.lit("")), "snippet"))
    prints = durable(materials.select(F.col(by).alias("_by"), "ord", simhash64(text).alias("fp")), "material-prints")
    # a bundle's own place in the fingerprint's space: near pairs of other bundles are left out where they meet
    ids = durable(prints.withColumn("id", F.struct("_by", "ord")), "material-ids")
    kept = _keep_first(ids.select("id"), near_in_groups(ids, radius), "group-pairs")
    return materials.join(kept.select(F.col("id._by").alias(by), F.col("id.ord").alias("ord")), [by, "ord"], "left_semi")


def near_in_groups(ids: DataFrame, radius: int) -> DataFrame:
    """(a, b) of ids with a < b of one group within the radius; a group is a bundle's materials, a few at most."""
    other = ids.select(F.col("_by"), F.col("id").alias("b"), F.col("fp").alias("g"))
    pairs = ids.select("_by", F.col("id").alias("a"), "fp").join(other, "_by").where("a < b")
    return pairs.where(hamming(F.col("fp"), F.col("g")) <= radius).select("a", "b")


def asked_tokens(description: Column) -> Column:
    """The distinct tokens of a description; to be made once for each description, before materials are joined to it."""
    return F.array_distinct(tokens(description))


def rerank(materials: DataFrame, asked: Column) -> DataFrame:
    """With score, the share of the asked tokens (see asked_tokens) that a material has; 0 if none are asked."""
    own = F.array_distinct(tokens(F.concat_ws(" ", "title", "snippet", "text")))
    return materials.withColumn("score", F.when(F.size(asked) > 0, F.size(F.array_intersect(own, asked)) / F.size(asked)).otherwise(F.lit(0.0)))


def hashed_terms(texts: DataFrame, key: str, buckets: int = 256) -> DataFrame:
    """(key, bucket, w): unsigned term counts in md5 buckets, of length one."""
    code = F.pmod(F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
    own = texts.select(key, F.explode(tokens(F.col("text"))).alias("term")).groupBy(key, code.alias("bucket")).agg(F.count("*").alias("n"))
    length = own.groupBy(key).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("len"))
    return own.join(length, key).select(key, "bucket", (F.col("n") / F.col("len")).alias("w"))


def recall(candidates: DataFrame, known: DataFrame, k: int = 8, digits: int = 9) -> DataFrame:
    """(cand, id, sim, rank): the k known texts (id, text) nearest to each candidate (cand, text) by hashed-bag cosine."""
    a, b = hashed_terms(candidates, "cand"), hashed_terms(known, "id")
    gathered = b.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.col("bucket").alias("term"), "w"))).alias("ts")).withColumn("norm", F.lit(1.0))
    found = _best(gathered, "id", a.select(F.col("cand").alias("qid"), F.col("bucket").alias("term"), "w"), k, digits)
    return found.select(F.col("qid").alias("cand"), "id", F.col("score").alias("sim"), "rank")


def link_materials(bundles: DataFrame, materials: DataFrame) -> DataFrame:
    """(bundle_id, material_id): materials linked to any node of a bundle."""
    nodes = bundles.select("bundle_id", F.explode("nodes").alias("id"))
    return nodes.join(materials.select("material_id", F.explode("linked_nodes").alias("id")), "id").select("bundle_id", "material_id").distinct()


def material_counts(nodes: DataFrame, materials: DataFrame, **judge) -> DataFrame:
    """Nodes with n_materials from their links, and status atomic where that makes them so; merged and frozen ones keep theirs."""
    from lodestone.operators.sampling import is_atomic

    counts = materials.select(F.explode(F.array_distinct("linked_nodes")).alias("id")).groupBy("id").agg(F.count("*").alias("_n"))
    out = nodes.join(counts, "id", "left").withColumn("n_materials", F.coalesce("_n", "n_materials"))
    atomic = is_atomic(F.col("level"), F.col("n_materials"), F.col("synth_success_rate"), F.col("child_material_overlap"), **judge)
    now = F.when(F.col("_n").isNotNull() & ~F.col("status").isin("merged", "frozen") & atomic, "atomic").otherwise(F.col("status"))
    return out.withColumn("status", now).drop("_n")
