"""Reports over nodes, tasks and materials, and the artifact log."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.blocks import groups_of, list_rows, shared_pairs
from lodestone.functions.text import word_ngrams
from lodestone.plans.durable import durable

RESULTS = ("pass", "fail", "sft_only", "unverified")


def coverage(nodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row for each level: n_nodes, n_sampled, n_atomic, n_atomic_unsampled."""
    hit = tasks.select(F.explode("nodes").alias("id")).distinct().withColumn("hit", F.lit(1))
    own = nodes.where("status <> 'merged'").join(hit, "id", "left")
    atomic = F.col("status") == "atomic"
    return own.groupBy("level").agg(F.count("*").alias("n_nodes"), F.count("hit").alias("n_sampled"), F.count_if(atomic).alias("n_atomic"), F.count_if(atomic & F.col("hit").isNull()).alias("n_atomic_unsampled"))


def long_tail(nodes: DataFrame, tasks: DataFrame) -> DataFrame:
    return coverage(nodes, tasks).agg(F.coalesce(F.sum("n_atomic_unsampled") / F.nullif(F.sum("n_atomic"), F.lit(0)), F.lit(0.0)).alias("long_tail_ratio"))


def jaccard_mean(tasks: DataFrame, n: int = 3, *, chunk: int = 8192) -> DataFrame:
    """The mean Jaccard similarity of the questions' n-grams over all pairs of tasks; no sample is taken.

    Equal sets of n-grams are one row with a weight. N-grams of one set alone are left out after sizes are known, and so are sets without
    others, as they share nothing. What is left is dealt into chunks; each pair of chunks is one task, which returns one number. Work
    follows the pairs of sets that share an n-gram; memory is that of a block, however common an n-gram is.
    """
    grams = tasks.select(F.array_sort(F.transform(word_ngrams(F.col("question"), n), lambda x: F.xxhash64(x))).alias("g"))
    sets = durable(grams.where(F.size("g") > 0).groupBy("g").agg(F.count("*").alias("w")).withColumn("k", F.monotonically_increasing_id()), "gram-sets")
    flat = sets.select("k", "w", F.size("g").alias("n"), F.explode("g").alias("x"))
    common = flat.groupBy("x").agg(F.count("*").alias("m")).where("m > 1").select("x")
    linked = durable(flat.join(common, "x", "left_semi").groupBy("k", "w", "n").agg(F.collect_list("x").alias("g")), "gram-links")
    chunks = max(1, -(-linked.count() // chunk))
    rows = linked.withColumn("c", F.pmod(F.xxhash64("k"), F.lit(chunks))).select("g", "w", "n", "c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("d"))
    rows = rows.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), (F.col("c") > F.col("d")).cast("int").alias("side"), "g", "w", "n")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for own in groups_of(batches, ["a", "b"]):
            found, side = list_rows(own.column("g")), own.column("side").to_numpy()
            w, size = own.column("w").to_numpy().astype(float), own.column("n").to_numpy().astype(float)
            inside = own.column("a")[0].as_py() == own.column("b")[0].as_py()
            left = len(own) if inside else int((side == 0).sum())
            if not inside and left in (0, len(own)):
                continue
            start = 0 if inside else left
            for i, j, shared in shared_pairs(found[:left], found[start:]):
                similar = w[i] * w[start + j] * shared / (size[i] + size[start + j] - shared)
                total += float(similar[i != j].sum()) / 2 if inside else float(similar.sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["s"])

    dealt = rows.repartition(chunks * (chunks + 1) // 2, "a", "b").sortWithinPartitions("a", "b", "side")
    total = dealt.mapInArrow(sums, "s double").unionByName(sets.select((F.col("w") * (F.col("w") - 1) / 2).alias("s"))).agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"))
    pairs = tasks.agg((F.count("*") * (F.count("*") - 1) / 2).alias("p"))
    return total.crossJoin(pairs).select(F.round(F.coalesce(F.col("s") / F.nullif("p", F.lit(0.0)), F.lit(0.0)), 6).alias("jaccard_mean"))


def material_reuse(tasks: DataFrame) -> DataFrame:
    used = tasks.select("task_id", F.explode(F.array_distinct("materials")).alias("m")).groupBy("m").agg(F.count("*").alias("n"))
    return used.agg(F.count("*").alias("n_used"), F.count_if(F.col("n") > 1).alias("n_reused"), F.round(F.coalesce(F.count_if(F.col("n") > 1) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 6).alias("reuse_rate"))


def diversity(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("task_type", "level").agg(F.count("*").alias("n"))


def quality(tasks: DataFrame) -> DataFrame:
    """Counts of each result by task type, and over all (task_type null)."""
    counts = [F.count_if(F.col("verify_result") == r).alias(f"n_{r}") for r in RESULTS]
    return tasks.rollup("task_type").agg(*counts)


def provenance(tasks: DataFrame, materials: DataFrame, nodes: DataFrame) -> DataFrame:
    """(task_id, ok): whether all of a task's materials and nodes exist."""
    m = tasks.select("task_id", F.explode("materials").alias("material_id")).join(materials.select("material_id"), "material_id", "left_anti").select("task_id")
    n = tasks.select("task_id", F.explode("nodes").alias("id")).join(nodes.select("id"), "id", "left_anti").select("task_id")
    bad = m.unionByName(n).distinct().withColumn("bad", F.lit(True))
    return tasks.select("task_id").join(bad, "task_id", "left").select("task_id", F.col("bad").isNull().alias("ok"))


def card_history(cards: DataFrame) -> DataFrame:
    """cards(name, seq, nodes, edges) with revision and deltas: unchanged cards make no revision."""
    by = Window.partitionBy("name").orderBy("seq")
    own = cards.withColumn("pn", F.lag("nodes").over(by)).withColumn("pe", F.lag("edges").over(by))
    own = own.where("pn is null or pn <> nodes or pe <> edges")
    return own.select("name", "seq", F.row_number().over(by).cast("bigint").alias("revision"), (F.col("nodes") - F.coalesce("pn", "nodes")).alias("d_nodes"), (F.col("edges") - F.coalesce("pe", "edges")).alias("d_edges"))


def latest(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).where("_rank = 1").drop("_rank")


def budget(calls: DataFrame, max_calls: int, max_cost: float, group: str = "run") -> DataFrame:
    """calls(run, seq, prompt, cost) with hit (the prompt was asked before in the run) and allowed: misses count, hits are free."""
    first = F.row_number().over(Window.partitionBy(group, "prompt").orderBy("seq"))
    own = calls.withColumn("hit", first > 1)
    before = Window.partitionBy(group).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    miss = F.when(~F.col("hit"), 1).otherwise(0)
    own = own.withColumn("spent", F.coalesce(F.sum(miss * F.col("cost")).over(before), F.lit(0.0))).withColumn("made", F.coalesce(F.sum(miss).over(before), F.lit(0)))
    return own.withColumn("allowed", F.col("hit") | ((F.col("made") < max_calls) & (F.col("spent") < max_cost)))


def report_text(found: dict) -> str:
    """A report's parts (lists of rows) in Markdown."""
    lines = ["# Run report", ""] + ([f"Run {found['run_id']}", ""] if found.get("run_id") else [])

    def table(title: str, columns: list[str], rows: list[dict]) -> None:
        lines.extend([f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)])
        lines.extend("| " + " | ".join(f"{r[c]:.4f}" if isinstance(r[c], float) else "all" if r[c] is None else str(r[c]) for c in columns) + " |" for r in rows)
        lines.append("")

    table("Coverage", ["level", "n_nodes", "n_sampled", "n_atomic", "n_atomic_unsampled"], sorted(found["coverage"], key=lambda r: r["level"]))
    lines += [f"Atomic nodes that were never sampled: {found['long_tail'][0]['long_tail_ratio']:.3f} of all atomic ones.", ""]
    lines += ["## Repetition", "", f"Mean similarity of questions: {found['similarity'][0]['jaccard_mean']:.4f}. Materials in more than one task: {found['reuse'][0]['reuse_rate']:.3f}.", ""]
    table("Task types by level", ["task_type", "level", "n"], sorted(found["diversity"], key=lambda r: (r["task_type"], r["level"])))
    table("Results", ["task_type", *[f"n_{x}" for x in RESULTS]], sorted(found["quality"], key=lambda r: (r["task_type"] is not None, r["task_type"] or "")))
    broken, every = sum(r["n"] for r in found["provenance"] if not r["ok"]), sum(r["n"] for r in found["provenance"])
    lines += ["## Provenance", "", f"Tasks whose materials and nodes all exist: {(every - broken) / every if every else 1:.3f}; others: {broken}.", ""]
    return "\n".join(lines)
