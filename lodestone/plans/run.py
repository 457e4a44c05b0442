"""Whole runs: build, sample, retrieve, synthesize, verify, export, report. Each stage reads the tables of those before it from the
work folder and writes its own as Parquet; a stage whose tables are there is skipped, or adds what is missing, unless resume is off.

Prompts go through one managed model, whose calls are bounded by `max_calls`; where they run out, the rest waits for the next run. Replies are
kept in a table of the work folder, so that a run that goes on pays for none again. All else is DataFrames.
"""

from __future__ import annotations

import copy
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import fields
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import json_part
from lodestone.operators import cards, graph, report, retrieval, sampling, tasks
from lodestone.plans import artifacts
from lodestone.plans.durable import durable
from lodestone.plans.growth import Growth, GrowthSettings, corpus_evidence
from lodestone.plans.model import ManagedModel, make_model
from lodestone.plans.retrieve import retrieve_materials
from lodestone.sources.adapter import analyze_corpus
from lodestone.sources.corpus import ExtractionSpec, read_corpus
from lodestone.sources.search import Fetch, check_sources, url_fetch

DEFAULTS: dict = {
    "name": "lodestone", "workdir": "lodestone-run", "seed": 42, "seeds": [], "model": "mock", "max_calls": 2000, "max_cost": 10.0, "rpm": 0.0,
    "build": {}, "grounded": True,
    "sample": {"n": 1000, "breadth": 0.2, "depth": 0.6, "joint": 0.2, "max_per_node": 20, "alpha": 1.0, "max_group": 4, "prioritizer": "inverse_frequency"},
    "retrieve": {"corpus": "corpus", "chunk_size": 800, "overlap": 100, "per_node": 8, "sources": ["local"], "adapter": "off", "license": "whitelist", "dedup": "simhash", "rerank": "overlap", "verify_tls": True},
    "synthesize": {"task_types": [x[0] for x in tasks.TASK_TYPES], "weights": {}, "language": "en", "insufficient": "reject_sample"},
    "verify": {"fallback": "rubric_judge", "pass_score": 0.7},
    "export": {"formats": ["sft", "rl"], "budget": 4000, "min_quality": 0.0},
}
STAGES = ("build", "sample", "retrieve", "synthesize", "verify", "export", "report")
TASK = "task_id string, bundle_id string, task_type string, level int, nodes array<string>, materials array<string>, prompt string, question string, answer string, rubric array<string>, verifier string, verify_result string, language string"


class MissingStage(RuntimeError):
    pass


def settings_of(own: dict | None = None) -> dict:
    """The defaults with what is given; unknown names raise ValueError."""
    out = copy.deepcopy(DEFAULTS)
    for k, v in (own or {}).items():
        if k not in out:
            raise ValueError(f"unknown setting {k!r}; known: {sorted(out)}")
        if k == "build" and (bad := set(v) - {f.name for f in fields(GrowthSettings)}):
            raise ValueError(f"unknown settings {sorted(bad)} of build")
        out[k] = {**out[k], **v} if isinstance(out[k], dict) else v
    return out


def settings_hash(settings: dict) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]


class Run:
    def __init__(self, spark: SparkSession, settings: dict | None = None, model: ManagedModel | None = None, resume: bool = True, fetch: Fetch | None = None):
        self.spark, self.settings, self.resume = spark, settings_of(settings), resume
        own = self.settings
        check_sources(own["retrieve"]["sources"])
        self.fetch = fetch or partial(url_fetch, verify=own["retrieve"]["verify_tls"])
        self.model = model or ManagedModel(make_model(own["model"]), own["max_calls"], own["max_cost"], rpm=own["rpm"])
        if self.has("model_cache"):
            self.model.kept = {r.key: r.reply for r in spark.read.parquet(self.path("model_cache")).collect()} | self.model.kept  # a row for each call that was paid for
        self.saved = set(self.model.kept)

    def path(self, name: str) -> str:
        return f"{self.settings['workdir'].rstrip('/')}/{name}"

    def has(self, name: str) -> bool:
        return artifacts.exists(self.spark, self.path(name))

    def save_replies(self) -> None:
        new = [(k, v) for k, v in self.model.kept.items() if k not in self.saved]
        if new:
            self.write(self.spark.createDataFrame(new, "key string, reply string"), "model_cache", "append")
            self.saved |= {k for k, _ in new}

    def text(self, name: str, value: str) -> None:
        self.spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(self.path(name))

    def spec(self) -> ExtractionSpec | None:
        """How the corpus is read: asked of the model once, where the adapter is `auto` and there is a local source."""
        own = self.settings["retrieve"]
        if own["adapter"] != "auto" or "local" not in own["sources"]:
            return None
        if self.resume and self.has("corpus_spec"):
            value = "\n".join(r.value for r in self.spark.read.text(self.path("corpus_spec")).collect())
            return ExtractionSpec.of(json.loads(value)) if value.strip() else None
        found = analyze_corpus(self.spark, own["corpus"], self.model)
        self.text("corpus_spec", found.json() if found else "")
        self.save_replies()
        return found

    def ingest(self) -> str | None:
        found = self.spec()
        return found.json() if found else None

    def read(self, name: str, stage: str) -> DataFrame:
        if not self.has(name):
            raise MissingStage(f"there is no table {name!r} in {self.settings['workdir']}; run {stage} first")
        return self.spark.read.parquet(self.path(name))

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(self.path(name))

    def chunks(self) -> DataFrame:
        own = self.settings["retrieve"]
        rows = retrieval.chunk_rows(read_corpus(self.spark, own["corpus"], self.spec()).withColumn("doc", F.struct("path", "doc_no")), own["chunk_size"], own["overlap"], "doc")
        return rows.select(F.concat(F.lit("m"), F.left(F.sha1(F.concat_ws("|", "doc.path", "doc.doc_no", "chunk_no").cast("binary")), F.lit(16))).alias("material_id"), "doc.path", "text")

    def build(self) -> None:
        if self.resume and self.has("flags"):
            return
        evidence = corpus_evidence(self.chunks(), 4, "material_id") if self.settings["grounded"] else None
        found = Growth(self.model, GrowthSettings(**self.settings["build"]), evidence).grow(self.settings["seeds"]).frames(self.spark)
        found["nodes"] = found["nodes"].drop("level").join(graph.levels(found["nodes"], found["edges"]), "id")
        for name in ("nodes", "edges", "decisions", "flags"):
            self.write(found[name], name)
        self.save_replies()
        self.card()

    def card(self) -> str:
        """The graph's card as Markdown; a changed graph makes a new revision."""
        build = {k: v for k, v in GrowthSettings(**self.settings["build"]).__dict__.items() if k in ("queue_policy", "max_depth", "max_children", "max_nodes")}
        old = None
        if self.has("card_json"):
            try:
                old = cards.Card.read(json.loads("\n".join(r.value for r in self.spark.read.text(self.path("card_json")).collect())))
            except ValueError:
                old = None  # a broken card is begun anew
        found = cards.stats(self.nodes(), self.read("edges", "build"), self.read("flags", "build"))
        card = cards.revised(old, self.settings["name"], found, build, settings_hash(self.settings), artifacts.utc_now())
        if card is not old:
            self.text("card_json", json.dumps(cards.card_json(card), ensure_ascii=False))
        self.text("card_md", cards.card_text(card))
        return cards.card_text(card)

    def nodes(self) -> DataFrame:
        return self.read("nodes_counted" if self.has("nodes_counted") else "nodes", "build")

    def sample(self) -> None:
        if self.resume and self.has("bundles"):
            return
        own, nodes, edges = self.settings["sample"], self.read("nodes", "build"), self.read("edges", "build")
        # what earlier draws took weighs on this one
        counted = self.read("samples", "sample") if self.has("samples") else nodes.select("id", F.lit(0).cast("bigint").alias("times_sampled"))
        quota = sampling.split_quota(own["n"], own["breadth"], own["depth"], own["joint"])
        drawn = sampling.draw_all(nodes, edges, counted, quota, seed=self.settings["seed"], cap=own["max_per_node"], alpha=own["alpha"], max_group=own["max_group"], prioritizer=own["prioritizer"])
        key = F.sha1(F.concat_ws("|", "intent", F.col("pick").cast("string"), "nodes").cast("binary"))
        every = drawn.select(F.concat(F.lit("sb_"), F.left(key, F.lit(16))).alias("bundle_id"), "intent", "nodes")
        self.write(sampling.assemble(every, nodes, graph.ancestor_paths(nodes, edges)), "bundles")
        old = nodes.select("id").join(counted, "id", "left")
        self.write(durable(sampling.count_samples(old, drawn), "samples"), "samples")

    def retrieve(self) -> None:
        if self.resume and self.has("nodes_counted"):
            return
        own, bundles, nodes = self.settings["retrieve"], self.read("bundles", "sample"), self.read("nodes", "build")
        found = retrieve_materials(bundles, nodes, self.chunks() if "local" in own["sources"] else None, own, self.fetch)
        self.write(found, "materials")
        counted = nodes.withColumns({"synth_success_rate": F.lit(None).cast("double"), "child_material_overlap": F.lit(None).cast("double")})
        build = GrowthSettings(**self.settings["build"])
        self.write(retrieval.material_counts(counted, self.read("materials", "retrieve"), max_depth=build.max_depth, min_materials=build.min_materials), "nodes_counted")
        self.card()

    def synthesize(self) -> None:
        own, bundles, materials = self.settings["synthesize"], self.read("bundles", "sample"), self.read("materials", "retrieve")
        if self.resume and self.has("tasks"):
            bundles = bundles.join(self.read("tasks", "synthesize").select("bundle_id"), "bundle_id", "left_anti")
        names = self.nodes().select(F.col("id").alias("n"), "label")
        labels = bundles.select("bundle_id", F.posexplode("nodes").alias("pos", "n")).join(names, "n", "left").withColumn("label", F.coalesce("label", "n")).groupBy("bundle_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]).alias("labels"))
        named = bundles.join(labels, "bundle_id").withColumn("paths", F.transform("nodes", lambda n: F.col("ancestor_paths")[n])).withColumn("language", F.lit(own["language"]))
        typed = named.withColumn("task_type", tasks.pick_type(F.col("intent"), F.col("bundle_id"), own["task_types"], own["weights"], self.settings["seed"]))
        linked = retrieval.link_materials(bundles, materials)
        gated = tasks.gate(typed, linked, tasks.task_types(self.spark))
        texts = linked.join(materials.select("material_id", "title", "snippet"), "material_id").withColumn("ord", F.dense_rank().over(graph.Window.partitionBy("bundle_id").orderBy("material_id")).cast("bigint"))
        ids = linked.groupBy("bundle_id").agg(F.array_sort(F.collect_set("material_id")).alias("materials"))
        ready = gated.join(tasks.prompts(typed, texts), "bundle_id").join(ids, "bundle_id", "left").withColumn("question", tasks.reject_task(F.col("labels"), F.col("language")))
        ready = durable(ready.withColumn("id", F.concat(F.lit("t_"), F.substring("bundle_id", 4, 64))), "ready")
        asked = self.model.answers(ready.where("enough").select("id", "prompt"), "synthesize").select("id", "reply")
        got = F.try_parse_json(json_part(F.col("reply")))
        field = lambda name: F.nullif(F.try_variant_get(got, f"$.{name}", "string"), F.lit(""))
        points = F.coalesce(F.filter(F.try_variant_get(got, "$.rubric", "array<string>"), lambda x: x.isNotNull()), F.array().cast("array<string>"))
        replied = asked.select("id", field("question").alias("q"), field("answer").alias("a"), points.alias("r")).where("q is not null and a is not null")
        same = [F.col("id").alias("task_id"), "bundle_id", "task_type", "level", "nodes", F.coalesce("materials", F.array().cast("array<string>")).alias("materials")]
        done = ready.join(replied, "id").select(*same, "prompt", F.col("q").alias("question"), F.col("a").alias("answer"), F.col("r").alias("rubric"), "verifier", F.when(F.col("verifier").isNull(), "sft_only").otherwise("unverified").alias("verify_result"), "language")
        if own["insufficient"] == "reject_sample":
            rejected = ready.where("not enough").select(*same, F.lit("").alias("prompt"), "question", tasks.reject_answer(F.col("language")).alias("answer"), F.array().cast("array<string>").alias("rubric"), F.lit(None).cast("string").alias("verifier"), F.lit("sft_only").alias("verify_result"), "language")
            done = done.unionByName(rejected)
        self.write(durable(done, "tasks"), "tasks", "append" if self.resume else "overwrite")
        self.save_replies()

    def verify(self) -> None:
        own, rows = self.settings["verify"], self.read("tasks", "synthesize")
        if self.resume and self.has("verified"):
            rows = rows.join(self.read("verified", "verify").select("task_id"), "task_id", "left_anti")
        rows = rows.withColumn("by", tasks.dispatch(F.col("verify_result"), F.col("verifier"), own["fallback"])).withColumn("match", tasks.answer_match(F.col("answer"), F.col("materials")))
        rows = durable(rows, "unverified")
        ask = F.concat(F.lit("Question: "), "question", F.lit("\nAnswer: "), "answer", F.lit("\nRubric: "), F.array_join("rubric", "; "), F.lit('\nScore each point from 0 to 1.\nReply with JSON: {"scores": [...]}'))
        judged = self.model.answers(rows.where("by = 'rubric_judge'").select(F.col("task_id").alias("id"), ask.alias("prompt")), "verify").where("reply is not null or error is not null")
        scores = F.try_variant_get(F.try_parse_json(json_part(F.col("reply"))), "$.scores", "array<double>")
        judged = judged.select(F.col("id").alias("task_id"), scores.alias("scores"), F.lit(True).alias("judged"))
        rows = rows.join(judged, "task_id", "left").where("by is null or by <> 'rubric_judge' or judged")
        result = F.when(F.col("by").isNull(), F.col("verify_result")).when(F.col("by") == "answer_match", F.col("match.result")).when(F.col("by") == "sft_only", "sft_only").otherwise(tasks.rubric_mean(F.col("scores"), own["pass_score"])["result"])
        done = rows.withColumn("verify_result", result).select(*[x.split()[0] for x in TASK.split(", ")])
        self.write(durable(done, "verified"), "verified", "append" if self.resume else "overwrite")
        self.save_replies()

    def export(self) -> dict[str, int]:
        own, done, materials = self.settings["export"], self.read("verified", "verify"), self.read("materials", "retrieve")
        contexts = tasks.context_blocks(done, materials, own["budget"], own["min_quality"])
        counts = tasks.manifest(done, materials)
        self.write(counts, "manifest")
        tasks.lineage(done, self.read("bundles", "sample")).select("line").write.mode("overwrite").text(self.path("lineage"))
        # a row for each type, result and source
        head = {"run_id": self.run_id, "settings_hash": settings_hash(self.settings), "tasks": done.count(), "materials": materials.count(), "counts": [r.asDict() for r in counts.orderBy("kind", "value").collect()], "model": {"calls": self.model.calls, "spent": self.model.spent}}
        self.text("manifest_json", json.dumps(head, ensure_ascii=False))
        return {fmt: tasks.write_export(tasks.grounded(done, materials, own["min_quality"]), contexts, fmt, self.path(f"tasks_{fmt}")) for fmt in own["formats"]}

    def report(self) -> dict[str, list]:
        """Small tables only: a row for each level, type or result."""
        done, materials, nodes = self.read("verified", "verify"), self.read("materials", "retrieve"), self.nodes()
        parts = {
            "coverage": report.coverage(nodes, done), "long_tail": report.long_tail(nodes, done), "similarity": report.jaccard_mean(done), "reuse": report.material_reuse(done),
            "diversity": report.diversity(done), "quality": report.quality(done), "provenance": report.provenance(done, materials, nodes).groupBy("ok").agg(F.count("*").alias("n")),
        }
        found = {"run_id": self.run_id} | {k: [r.asDict() for r in df.collect()] for k, df in parts.items()}
        self.text("report", json.dumps(found, ensure_ascii=False))
        self.text("report_md", report.report_text(found))
        return found

    run_id: str | None = None

    def all(self, stages: tuple[str, ...] = STAGES) -> dict:
        """Runs the stages and notes the run, with its headline figures, in the table of runs."""
        self.run_id = f"run_{uuid.uuid4().hex[:12]}"
        runs = self.path("runs")
        artifacts.upsert(self.spark.createDataFrame([(self.run_id, artifacts.utc_now(), None, settings_hash(self.settings), "{}", "{}")], artifacts.RUN), runs)
        out: dict = {"settings_hash": settings_hash(self.settings)}
        for name in stages:
            stage: Callable = getattr(self, name)
            out[name] = stage()
        stats = {"export": out.get("export")}
        if found := out.get("report"):
            every = sum(r["n"] for r in found["provenance"])
            stats |= {"n_nodes": sum(r["n_nodes"] for r in found["coverage"]), "long_tail_ratio": found["long_tail"][0]["long_tail_ratio"], "provenance": sum(r["n"] for r in found["provenance"] if r["ok"]) / every if every else 1.0}
            out["report"] = {k: v for k, v in found.items() if k != "run_id"}
        artifacts.finish_run(self.spark, runs, self.run_id, stage_stats=json.dumps(stats), model_usage=json.dumps({"calls": self.model.calls, "spent": self.model.spent}))
        return out
