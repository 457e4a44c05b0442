"""The concept graph: nodes(id, label, aliases, status, ...) and edges(parent, child, relation, confidence)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import label_key
from lodestone.plans.durable import durable


def live(nodes: DataFrame) -> DataFrame:
    return nodes.where("status <> 'merged'")


def subconcepts(edges: DataFrame) -> DataFrame:
    return edges.where("relation = 'is_subconcept'")


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, n_parents, n_children over sub-concept edges."""
    own = subconcepts(edges)
    ends = own.select(F.col("child").alias("id"), F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(own.select(F.col("parent").alias("id"), F.lit(0).alias("p"), F.lit(1).alias("c")))
    sums = ends.groupBy("id").agg(F.sum("p").alias("n_parents"), F.sum("c").alias("n_children"))
    return live(nodes).select("id").join(sums, "id", "left").na.fill(0)


def get(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of ids(id), merged ones too."""
    return nodes.join(ids.select("id").distinct(), "id", "left_semi")


def contains(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """ids(id) with `known`."""
    return ids.join(nodes.select("id", F.lit(True).alias("known")), "id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def parents(edges: DataFrame, ids: DataFrame, subconcept_only: bool = True) -> DataFrame:
    """(id, parent) for ids(id)."""
    own = subconcepts(edges) if subconcept_only else edges
    return own.select(F.col("child").alias("id"), "parent").join(ids.select("id").distinct(), "id", "left_semi").distinct()


def children(edges: DataFrame, ids: DataFrame, subconcept_only: bool = True) -> DataFrame:
    """(id, child) for ids(id)."""
    own = subconcepts(edges) if subconcept_only else edges
    return own.select(F.col("parent").alias("id"), "child").join(ids.select("id").distinct(), "id", "left_semi").distinct()


def find(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, id): live nodes whose label or alias equals a label in normal form; the last such node wins (by ord)."""
    names = live(nodes).select("id", "ord", F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    index = names.groupBy(label_key(F.col("name")).alias("key")).agg(F.max_by("id", F.struct("ord", "id")).alias("id"))
    return labels.withColumn("key", label_key(F.col("label"))).join(index, "key", "left").drop("key")


def insert_absent(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """nodes with those of `new` (in the same columns) whose label is no label or alias yet; of equal new labels the first stays."""
    names = nodes.select(F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n")).select(label_key(F.col("n")).alias("_key")).distinct()
    first = Window.partitionBy("_key").orderBy("ord", "id")
    fresh = new.withColumn("_key", label_key(F.col("label"))).withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
    return nodes.unionByName(fresh.join(names, "_key", "left_anti").drop("_key", "_rank"))


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level): the least distance from any root; 0 where none reaches. One join for each level, never all paths."""
    own = subconcepts(edges).select("parent", "child").join(live(nodes).select(F.col("id").alias("child")), "child")
    ids = live(nodes).select("id")
    front = durable(ids.join(own.select(F.col("child").alias("id")), "id", "left_anti").select("id", F.lit(0).alias("level")), "levels")
    seen = front
    for k in itertools.count(1):
        step = own.join(front.select(F.col("id").alias("parent")), "parent").select(F.col("child").alias("id")).distinct()
        front = durable(step.join(seen.select("id"), "id", "left_anti").select("id", F.lit(k).alias("level")), "levels")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return ids.join(seen, "id", "left").select("id", F.coalesce("level", F.lit(0)).alias("level"))


def ancestor_paths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, path): the labels of the shortest path from a root, the smallest of equals."""
    own = subconcepts(edges).select("parent", "child")
    named = live(nodes).select("id", "label")
    front = durable(named.join(own.select(F.col("child").alias("id")), "id", "left_anti").select("id", F.array("label").alias("path")), "paths")
    seen = front
    while True:
        step = own.join(front.select(F.col("id").alias("parent"), "path"), "parent").select(F.col("child").alias("id"), "path")
        step = step.join(seen.select("id"), "id", "left_anti").groupBy("id").agg(F.min("path").alias("path")).join(named, "id")
        front = durable(step.select("id", F.concat("path", F.array("label")).alias("path")), "paths")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def closure(edges: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id, ancestor): all ancestors of all nodes, or of ids(id), found by joining only what the last round added."""
    up = subconcepts(edges).select(F.col("child").alias("via"), F.col("parent").alias("above")).distinct()
    own = up.select(F.col("via").alias("id"), F.col("above").alias("ancestor"))
    front = durable(own if ids is None else own.join(ids.select("id").distinct(), "id", "left_semi"), "closure")
    seen = front
    while not front.isEmpty():
        step = front.join(up, front["ancestor"] == up["via"]).select("id", F.col("above").alias("ancestor")).distinct()
        front = durable(step.join(seen, ["id", "ancestor"], "left_anti"), "closure")
        seen = seen.unionByName(front)
    return seen


def add_edges(edges: DataFrame, new: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges after the additions, and the rejected ones with a reason: unknown_node, or cycle_prevented.

    One edge for each (parent, child); a later relation takes its place. A sub-concept edge is rejected if its child is an
    ancestor of its parent already, or through the other additions.
    """
    ids = nodes.select("id")
    known = new.join(ids.select(F.col("id").alias("parent")), "parent", "left_semi").join(ids.select(F.col("id").alias("child")), "child", "left_semi")
    unknown = new.join(known.select("parent", "child"), ["parent", "child"], "left_anti").withColumn("reason", F.lit("unknown_node"))
    columns = ["parent", "child", "relation", "confidence"]
    # only from the ends of the additions upwards
    ends = known.where("relation = 'is_subconcept'").select(F.col("parent").alias("id"))
    above = closure(edges.select(columns).unionByName(known.select(columns)), ends)
    loops = above.select(F.col("id").alias("parent"), F.col("ancestor").alias("child"))
    bad = known.where("relation = 'is_subconcept'").join(loops, ["parent", "child"], "left_semi").unionByName(known.where("relation = 'is_subconcept' and parent = child")).distinct()
    good = known.join(bad.select("parent", "child"), ["parent", "child"], "left_anti")
    newest = Window.partitionBy("parent", "child").orderBy(F.desc("_new"), F.desc("relation"))
    both = edges.select(*columns, F.lit(0).alias("_new")).unionByName(good.select(*columns, F.lit(1).alias("_new")))
    kept = both.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").select(columns)
    return kept, unknown.select(*columns, "reason").unionByName(bad.select(*columns, F.lit("cycle_prevented").alias("reason")))


def merge(nodes: DataFrame, edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merges duplicates into canonical nodes, pairs(dup, canon): names move to the canonical node, sub-concept children are re-pointed."""
    dup = pairs.select(F.col("dup").alias("id"), "canon")
    lost = nodes.join(dup, "id").select("canon", F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"))
    names = lost.groupBy(F.col("canon").alias("id")).agg(F.flatten(F.collect_list("names")).alias("_more"))
    out = nodes.join(names, "id", "left").join(dup.withColumnRenamed("canon", "_canon"), "id", "left")
    own = F.coalesce("aliases", F.array().cast("array<string>"))
    added = F.filter(F.coalesce("_more", F.array().cast("array<string>")), lambda x: x != F.col("label"))
    out = out.withColumn("aliases", F.array_sort(F.array_union(own, added))).withColumn("status", F.when(F.col("_canon").isNotNull(), "merged").otherwise(F.col("status"))).drop("_more", "_canon")
    moved = edges.join(pairs.select(F.col("dup").alias("parent"), "canon"), "parent", "left")
    moved = moved.withColumn("_moved", (F.col("canon").isNotNull() & (F.col("relation") == "is_subconcept")).cast("int"))
    moved = moved.withColumn("parent", F.when(F.col("_moved") == 1, F.col("canon")).otherwise(F.col("parent"))).where("parent <> child")
    first = Window.partitionBy("parent", "child").orderBy("_moved", "relation")
    return out, moved.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(*edges.columns)


def soft_violations(leveled: DataFrame, edges: DataFrame) -> DataFrame:
    """Sub-concept edges whose child is no deeper than its parent, from (id, level)."""
    p, c = leveled.select(F.col("id").alias("parent"), F.col("level").alias("parent_level")), leveled.select(F.col("id").alias("child"), F.col("level").alias("child_level"))
    return subconcepts(edges).select("parent", "child").join(p, "parent").join(c, "child").where("child_level <= parent_level").select(F.lit("level_soft_violation").alias("kind"), "parent", "child", "parent_level", "child_level").distinct()


def cap_parents(edges: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The edges with at most `most` sub-concept parents for each child (highest confidence, then name), and those over the cap."""
    rank = F.row_number().over(Window.partitionBy("child").orderBy(F.desc("confidence"), "parent"))
    ranked = subconcepts(edges).withColumn("_rank", rank)
    over = ranked.where(F.col("_rank") > most).drop("_rank")
    return ranked.where(F.col("_rank") <= most).drop("_rank").unionByName(edges.where("relation <> 'is_subconcept'")), over


def dot_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The lines of a DOT graph, but for its braces."""
    name = F.translate("label", '"', "'")
    own = live(nodes).select(F.format_string('"%s" [label="%s\\nL%d %s"];', "id", name, F.col("level"), "status").alias("line"))
    style = F.when(F.col("relation") == "is_subconcept", "solid").otherwise("dashed")
    return own.unionByName(edges.select(F.format_string('"%s" -> "%s" [style=%s];', "parent", "child", style).alias("line")))


def json_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, line): live nodes and all edges as JSON objects with all their columns."""
    whole = {"ignoreNullFields": "false"}
    own = live(nodes).select(F.lit("node").alias("part"), F.to_json(F.struct(*nodes.columns), whole).alias("line"))
    return own.unionByName(edges.select(F.lit("edge").alias("part"), F.to_json(F.struct(*edges.columns), whole).alias("line")))


def drawn(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, size, colour, border): how a drawing shows a live node: 8 and 3 for each child, one of seven colours by level, a thick border if atomic."""
    own = degrees(nodes, edges).select("id", (8 + 3 * F.col("n_children")).alias("size"))
    return live(nodes).select("id", "level", "status").join(own, "id").select("id", "size", F.least("level", F.lit(6)).alias("colour"), (F.col("status") == "atomic").alias("border"))


def review(flags: DataFrame, queue: str = "all") -> DataFrame:
    """The flags of a queue: all, or parents (nodes with too many parents, and levels out of order)."""
    if queue not in ("all", "parents"):
        raise ValueError(f"queue must be all or parents, not {queue!r}")
    return flags if queue == "all" else flags.where(F.col("kind").isin("max_parents_exceeded", "level_soft_violation"))


def card_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row for each level: nodes, atomic nodes, described nodes, nodes with materials, edges that end there."""
    into = edges.groupBy(F.col("child").alias("id")).agg(F.count("*").alias("n_in"))
    return live(nodes).join(into, "id", "left").groupBy("level").agg(
        F.count("*").alias("n_nodes"), F.count_if(F.col("status") == "atomic").alias("n_atomic"), F.count_if(F.col("description") != "").alias("n_described"),
        F.count_if(F.col("n_materials") > 0).alias("n_with_materials"), F.coalesce(F.sum("n_in"), F.lit(0)).alias("n_edges_in"),
    )
