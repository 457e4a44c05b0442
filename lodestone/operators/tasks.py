"""Tasks: types, prompts, gates, verification, export and manifests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions.text import answer_form, strip
from lodestone.operators.sampling import seeded

#: Task type, least number of materials, verifier.
TASK_TYPES = [("atomic_qa", 1, "answer_match"), ("aggregated_qa", 2, "answer_match"), ("multihop_qa", 2, "answer_match"), ("grounded_summary", 1, None), ("comparative_analysis", 2, None)]
VERIFIERS = ("answer_match", "rubric_judge")
_REGISTRY: dict[str, tuple[int, str | None]] = {name: (least, verifier) for name, least, verifier in TASK_TYPES}
#: The answers of tasks about which there are too few materials.
REJECT_ANSWERS = {
    "zh": "根据现有检索到的材料，信息不足，无法可靠回答该问题。",
    "en": "The retrieved materials do not contain enough information to answer this question reliably.",
}


def register_task_type(name: str, min_docs: int = 1, verifier: str | None = None) -> None:
    _REGISTRY[name] = (min_docs, verifier)


def get_task_type(name: str) -> tuple[int, str | None]:
    """(least number of materials, verifier)"""
    if name not in _REGISTRY:
        raise ValueError(f"unknown task type {name!r}; known: {list_task_types()}")
    return _REGISTRY[name]


def list_task_types() -> list[str]:
    return sorted(_REGISTRY)


def task_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in _REGISTRY.items()], "task_type string, min_docs int, verifier string")


def pick_type(intent: Column, key: Column, enabled: list[str], weights: dict[str, float] | None = None, seed: int = 42) -> Column:
    """multihop_qa for joint bundles if it is enabled, else a seeded draw by weight (1 unless given)."""
    if not enabled:
        raise ValueError("no task type is enabled")
    own = [(t, (weights or {}).get(t, 1.0)) for t in enabled]
    total = sum(w for _, w in own)
    u = seeded(seed, key) * total
    ordered, upto = None, 0.0
    for t, w in own[:-1]:
        upto += w
        ordered = F.when(u < upto, t) if ordered is None else ordered.when(u < upto, t)
    out = F.lit(own[-1][0]) if ordered is None else ordered.otherwise(own[-1][0])
    return F.when(intent == "joint", "multihop_qa").otherwise(out) if "multihop_qa" in enabled else out


def reject_task(labels: Column, language: Column) -> Column:
    """The question of a task about which there are too few materials."""
    named = F.array_join(labels, "、")
    return F.when(language == "zh", F.concat(F.lit("请介绍："), named, F.lit("。"))).otherwise(F.concat(F.lit("Explain: "), F.array_join(labels, ", "), F.lit(".")))


def reject_answer(language: Column) -> Column:
    return F.when(language == "zh", REJECT_ANSWERS["zh"]).otherwise(REJECT_ANSWERS["en"])


def prompts(bundles: DataFrame, materials: DataFrame) -> DataFrame:
    """(bundle_id, prompt) from bundles(bundle_id, labels, paths, task_type, language) and materials(bundle_id, material_id, title, snippet, ord)."""
    lines = F.array_join(F.transform(F.arrays_zip("labels", "paths"), lambda x: F.concat(F.lit("- "), x["labels"], F.lit(" (path: "), F.array_join(x["paths"], " > "), F.lit(")"))), "\n")
    cited = materials.groupBy("bundle_id").agg(F.array_sort(F.collect_list(F.struct("ord", F.concat(F.lit("["), F.col("material_id"), F.lit("] "), F.col("title"), F.lit(": "), F.col("snippet")).alias("s")))).alias("m"))
    body = F.array_join(F.transform(F.coalesce("m", F.array().cast("array<struct<ord:bigint,s:string>>")), lambda x: x["s"]), "\n")
    text = F.concat(
        F.lit("Write one task of type "), F.col("task_type"), F.lit(" in "), F.col("language"), F.lit(".\nConcepts:\n"), lines, F.lit("\nMaterials:\n"), body,
        F.lit("\nCite the materials that the answer rests on by their ids in brackets. Ask only what they answer.\nReply with JSON: {\"question\": ..., \"answer\": ..., \"rubric\": [...]}"),
    )
    return bundles.join(cited.select("bundle_id", F.col("m").cast("array<struct<ord:bigint,s:string>>").alias("m")), "bundle_id", "left").select("bundle_id", text.alias("prompt"))


def gate(bundles: DataFrame, linked: DataFrame, types: DataFrame) -> DataFrame:
    """bundles(bundle_id, task_type) with n_materials and enough, whether the type's least number is reached."""
    counts = linked.groupBy("bundle_id").agg(F.count("*").alias("n_materials"))
    out = bundles.join(counts, "bundle_id", "left").join(F.broadcast(types), "task_type").withColumn("n_materials", F.coalesce("n_materials", F.lit(0)))
    return out.withColumn("enough", F.col("n_materials") >= F.col("min_docs"))


def answer_match(answer: Column, materials: Column) -> Column:
    """struct(result, score, cited): pass if the answer, in normal form, has the id of any material."""
    own = answer_form(answer)
    n = F.size(F.filter(materials, lambda m: F.contains(own, answer_form(m))))
    ok = (F.coalesce(own, F.lit("")) != "") & (n > 0)
    return F.struct(F.when(ok, "pass").otherwise("fail").alias("result"), F.when(ok, 1.0).otherwise(0.0).alias("score"), F.when(ok, n).otherwise(0).alias("cited"))


def rubric_mean(scores: Column, pass_score: float = 0.7) -> Column:
    """struct(result, score): fails on null, empty or null-holding scores, else passes from a mean of pass_score.

    What passes is decided on sums of decimals of 12 digits after the point, so neither the order of scores nor the rounding of doubles decides
    a mean that equals pass_score. Scores that no decimal holds (infinite, NaN, from 1e25) are compared as they are.
    """
    kind, n = "decimal(37,12)", F.size(scores)
    bad = scores.isNull() | (n == 0) | F.exists(scores, lambda x: x.isNull())
    mean = F.aggregate(F.array_sort(scores), F.lit(0.0), lambda a, x: a + x) / n
    total = F.aggregate(F.transform(scores, lambda x: x.try_cast(kind)), F.lit(0).cast(kind), lambda a, x: (a + x).try_cast(kind))
    enough = F.coalesce(total >= F.lit(Decimal(repr(float(pass_score)))) * n, mean >= pass_score)
    return F.when(bad, F.struct(F.lit("fail").alias("result"), F.lit(0.0).alias("score"))).otherwise(F.struct(F.when(enough, "pass").otherwise("fail").alias("result"), mean.alias("score")))


def dispatch(verify_result: Column, verifier: Column, fallback: str = "rubric_judge") -> Column:
    """The verifier that decides a task; null if its result stays, `sft_only` if no known verifier is left."""
    last = fallback if fallback in VERIFIERS else "sft_only"
    return F.when((verify_result == "sft_only") | verifier.isNull(), F.lit(None).cast("string")).when(verifier.isin(*VERIFIERS), verifier).otherwise(last)


def context_blocks(tasks: DataFrame, materials: DataFrame, budget: int = 4000, min_quality: float = 0.0) -> DataFrame:
    """(task_id, context): the cited materials in order, cut where their texts reach the budget, between a header and the question's mark."""
    cited = tasks.select("task_id", "language", F.posexplode("materials").alias("pos", "material_id"))
    # a text of white space only is no reason to take the snippet
    body = strip(F.coalesce(F.nullif("text", F.lit("")), "snippet"))
    own = cited.join(materials.where(F.col("quality_score") >= min_quality).select("material_id", "title", body.alias("body")), "material_id").where("body <> ''")
    before = F.coalesce(F.sum(F.length("body")).over(Window.partitionBy("task_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.withColumn("left", F.lit(budget) - before).where("left > 0")
    block = strip(F.concat(F.lit("["), F.col("material_id"), F.lit("] "), F.coalesce("title", F.lit("")), F.lit("\n"), F.left(F.col("body"), F.col("left").cast("int"))))
    blocks = own.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("pos", block.alias("b")))).alias("bs"))
    zh = F.startswith(F.lower(F.coalesce("language", F.lit(""))), F.lit("zh"))
    text = F.concat(F.when(zh, "材料：").otherwise("Materials:"), F.lit("\n"), F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n"), F.lit("\n\n"), F.when(zh, "问题：").otherwise("Question："))
    return tasks.join(blocks, "task_id", "left").select("task_id", F.when(F.col("bs").isNull(), "").otherwise(text).alias("context"))


def grounded(tasks: DataFrame, materials: DataFrame, min_quality: float) -> DataFrame:
    """Tasks without materials, or with one of at least min_quality; all if that is 0 or less."""
    if min_quality <= 0:
        return tasks
    good = tasks.select("task_id", F.explode("materials").alias("material_id")).join(materials.where(F.col("quality_score") >= min_quality), "material_id").select("task_id").distinct()
    return tasks.where(F.size("materials") == 0).unionByName(tasks.where(F.size("materials") > 0).join(good, "task_id", "left_semi"))


def export_sft(tasks: DataFrame, contexts: DataFrame) -> DataFrame:
    """(task_id, line): JSON lines of tasks that passed or are for fine-tuning only."""
    own = tasks.where(F.col("verify_result").isin("pass", "sft_only")).join(contexts, "task_id", "left")
    ask = F.concat(F.coalesce("context", F.lit("")), F.col("question"))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return own.select("task_id", F.to_json(F.struct(F.array(message("user", ask), message("assistant", F.col("answer"))).alias("messages"), "task_id", "task_type"), {"ignoreNullFields": "false"}).alias("line"))


def export_rl(tasks: DataFrame, contexts: DataFrame) -> DataFrame:
    """(task_id, line): JSON lines of tasks that passed a verifier."""
    own = tasks.where("verify_result = 'pass' and verifier is not null").join(contexts, "task_id", "left")
    return own.select("task_id", F.to_json(F.struct("task_id", F.col("question").alias("prompt"), F.coalesce("context", F.lit("")).alias("context"), "rubric", "verifier", F.lit(None).cast("string").alias("env")), {"ignoreNullFields": "false"}).alias("line"))


def write_export(tasks: DataFrame, contexts: DataFrame, fmt: str, path: str) -> int:
    if fmt not in ("sft", "rl"):
        raise ValueError(f"format must be sft or rl, not {fmt!r}")
    lines = (export_sft if fmt == "sft" else export_rl)(tasks, contexts)
    lines.select("line").write.mode("overwrite").text(path)
    return lines.count()


def manifest(tasks: DataFrame, materials: DataFrame) -> DataFrame:
    """(kind, value, n): counts by task type, result and source type."""
    own = tasks.select(F.explode(F.array(F.struct(F.lit("task_type").alias("kind"), F.col("task_type").alias("value")), F.struct(F.lit("verify_result").alias("kind"), F.col("verify_result").alias("value")))).alias("x")).select("x.*")
    return own.unionByName(materials.select(F.lit("source_type").alias("kind"), F.col("source_type").alias("value"))).groupBy("kind", "value").agg(F.count("*").alias("n"))


def lineage(tasks: DataFrame, bundles: DataFrame) -> DataFrame:
    """(task_id, line): a JSON object for each task: its nodes and their paths, materials, verifier and result."""
    own = tasks.join(bundles.select("bundle_id", "ancestor_paths"), "bundle_id", "left")
    return own.select("task_id", F.to_json(F.struct("task_id", "task_type", "nodes", "ancestor_paths", F.col("materials").alias("material_ids"), "verifier", "verify_result"), {"ignoreNullFields": "false"}).alias("line"))


def labels_of(tasks: DataFrame) -> DataFrame:
    """(task_id, label): how a list shows a task."""
    return tasks.select("task_id", F.concat("task_id", F.lit(" ["), "task_type", F.lit("/"), "verify_result", F.lit("] "), F.left("question", F.lit(36))).alias("label"))


def detail(tasks: DataFrame) -> DataFrame:
    """(task_id, text, provenance): a task in Markdown, and where it comes from as JSON."""
    points = F.array_join(F.transform("rubric", lambda x: F.concat(F.lit("- "), x)), "\n")
    text = F.concat(F.lit("### "), "task_type", F.lit(" · "), "verify_result", F.lit("\n\n**Q** "), "question", F.lit("\n\n**A** "), "answer", F.lit("\n\n**rubric**\n"), points)
    return tasks.select("task_id", text.alias("text"), F.to_json(F.struct("task_id", "verifier", "materials", "nodes"), {"ignoreNullFields": "false"}).alias("provenance"))


def chosen(tasks: DataFrame, task_type: str = "all", result: str = "all") -> DataFrame:
    for column, value in (("task_type", task_type), ("verify_result", result)):
        tasks = tasks if value == "all" else tasks.where(F.col(column) == value)
    return tasks
