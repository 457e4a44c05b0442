import json
import threading
import urllib.request

import pytest

from lodestone.__main__ import main
from lodestone.api import load_graph, load_materials, load_sample_bundles
from lodestone.plans import artifacts
from lodestone.plans.model import ManagedModel, ScriptedModel
from lodestone.plans.retrieve import retrieve_materials, targets
from lodestone.plans.run import MissingStage, Run, settings_hash, settings_of
from lodestone.serve import page, server
from lodestone.sources.search import SourceError


def brief(*labels):
    return json.dumps({"definition": "d", "candidates": [{"label": x} for x in labels]})


def test_run(spark, tmp_path, capsys):
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    for name, text in (("a", "soil horizons hold clay and humus"), ("b", "soil texture is sand silt clay"), ("c", "rock erosion makes sand"), ("d", "music theory")):
        (corpus / f"{name}.txt").write_text(text)
    settings = {
        "workdir": str(tmp_path / "run"), "seeds": [{"label": "soil", "children": ["clay"]}, {"label": "rock"}],
        "sample": {"n": 6}, "retrieve": {"corpus": str(corpus)}, "synthesize": {"task_types": ["atomic_qa", "multihop_qa"]},
    }
    script = {"Concept: soil\n": brief("humus", "texture"), "Concept: ": brief(), "Write one task": json.dumps({"question": "What?", "answer": "Clay.", "rubric": ["x"]})}
    model = ManagedModel(ScriptedModel(script, '{"scores": [1.0]}'))
    with pytest.raises(MissingStage, match="run build first"):
        Run(spark, settings, model).sample()
    out = Run(spark, settings, model).all()
    assert sum(r["n_nodes"] for r in out["report"]["coverage"]) == 5
    run = Run(spark, settings, model)
    done = run.read("verified", "verify").collect()
    assert done and {r.verify_result for r in done} <= {"fail", "sft_only", "pass"} and out["export"]["sft"] == sum(r.verify_result != "fail" for r in done)
    assert len(done) == run.read("bundles", "sample").count() and [r["ok"] for r in out["report"]["provenance"]] == [True]
    calls = model.calls
    again = run.all()
    assert model.calls == calls and again == out and run.read("verified", "verify").count() == len(done)
    # replies are kept in the work folder: another client pays for none of them
    other = Run(spark, settings, ManagedModel(ScriptedModel({}, "no JSON")))
    assert other.model.kept == model.kept and len(other.model.kept) > 3
    runs = artifacts.load(spark, run.path("runs"), "run_id").collect()
    assert len(runs) == 2 and all(r.finished_at and json.loads(r.stage_stats)["provenance"] == 1.0 for r in runs)
    lines = [json.loads(r.value) for r in spark.read.text(run.path("lineage")).collect()]
    assert {x["task_id"] for x in lines} == {r.task_id for r in done} and all(set(x["ancestor_paths"]) == set(x["nodes"]) for x in lines)
    picks = [x for r in run.read("bundles", "sample").collect() for x in r.nodes]
    assert {r.id: r.times_sampled for r in run.read("samples", "sample").collect()} == {r.id: picks.count(r.id) for r in run.nodes().collect()}
    assert "# Run report" in "\n".join(r.value for r in spark.read.text(run.path("report_md")).collect())
    assert "revision 2" in run.card() and run.card() == run.card()
    loaded = load_graph(spark, settings["workdir"])
    assert {r.id: r.level for r in loaded["nodes"].collect()} == {r.id: r.level for r in run.nodes().collect()}
    assert load_materials(spark, settings["workdir"]).count() > 0 and load_sample_bundles(spark, settings["workdir"]).count() == len({r.bundle_id for r in done})
    for path, want in (("/", "verified"), ("/table/nodes", "soil"), ("/tasks?type=atomic_qa", "atomic_qa/"), (f"/task/{done[0].task_id}", "rubric")):
        status, body = page(run, path)
        assert status == 200 and want in body
    assert page(run, "/table/none")[0] == page(run, "/task/none")[0] == page(run, "/task/x'--")[0] == 404
    web = server(spark, settings, port=0)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    assert b"soil" in urllib.request.urlopen(f"http://127.0.0.1:{web.server_address[1]}/table/nodes").read()
    web.shutdown()
    (tmp_path / "s.json").write_text(json.dumps(settings))
    for words in (["graph", "--format", "json"], ["review", "--queue", "parents"], ["tasks", "--type", "atomic_qa"], ["card"], ["ingest"]):
        assert main([words[0], str(tmp_path / "s.json"), *words[1:]]) == 0
    assert main(["graph", str(tmp_path / "s.json")]) == 0 and '"soil"' not in capsys.readouterr().err
    (tmp_path / "t.json").write_text(json.dumps(settings | {"workdir": str(tmp_path / "none")}))
    assert main(["sample", str(tmp_path / "t.json")]) == 1 and "run build first" in capsys.readouterr().err


def test_retrieval_from_several_sources(spark):
    nodes = spark.createDataFrame([("a", "bread", "bread of rye"), ("b", "yeast", "wild yeast")], "id string, label string, description string")
    bundles = spark.createDataFrame([("b1", "joint", ["a", "b", "gone"], {"a": ["food", "bread"], "b": ["food", "yeast"]}), ("b2", "depth", ["a"], {"a": ["food", "bread"]})], "bundle_id string, intent string, nodes array<string>, ancestor_paths map<string,array<string>>")
    chunks = spark.createDataFrame([("m1", "f/x.txt", "rye bread and wild yeast"), ("m2", "f/y.txt", "nothing of it")], "material_id string, path string, text string")
    items = {"items": [{"html_url": "http://g/1", "full_name": "bread", "description": "on rye bread"}, {"html_url": "http://g/1/", "full_name": "copy"}]}

    def fetch(url, body, headers):
        if "github" in url:
            return json.dumps(items).encode()
        raise SourceError("down")

    how = {"sources": ["local", "github", "arxiv"], "per_node": 3, "license": "whitelist", "dedup": "url", "rerank": "overlap"}
    found = {(r.source_type, r.title): r for r in retrieve_materials(bundles, nodes, chunks, how, fetch).collect()}
    assert set(found) == {("local", "x.txt"), ("github", "bread")}
    assert found["local", "x.txt"].linked_nodes == ["a"] and found["github", "bread"].uri == "http://g/1" and found["github", "bread"].quality_score > 0
    asked = {(r.bundle_id, r.id): r for r in targets(bundles, nodes).collect()}
    assert asked["b1", "gone"].label == "gone" and asked["b1", "gone"].path == [] and asked["b1", "a"].others == ["bread", "yeast", "gone"] and asked["b2", "a"].others == []
    with pytest.raises(SourceError, match="down"):
        retrieve_materials(bundles, nodes, None, how | {"sources": ["arxiv"]}, fetch).collect()


def test_budgets_of_dealt_calls(spark):
    prompts = spark.createDataFrame([(i, f"p{i % 7}") for i in range(20)], "id int, prompt string")
    model = ManagedModel(ScriptedModel({"p": "r"}, cost=0.5), max_calls=5)
    rows = model.answers(prompts, "x", wave=2).collect()
    assert len(rows) == 20 and model.calls == 5 and len({r.prompt for r in rows if r.reply == "r"}) == 5
    model.max_calls = 99
    assert all(r.reply == "r" for r in model.answers(prompts, "x").collect()) and model.calls == 7 and model.spent == 3.5
    poor = ManagedModel(ScriptedModel({"p": "r"}, cost=1.0), max_cost=2.0)
    assert sum(r.reply is None for r in poor.answers(prompts, "x", wave=1).collect()) > 0 and poor.calls == 2

    class Failing(ScriptedModel):
        def complete(self, prompt):
            raise KeyError("no")

    assert all("KeyError" in r.error for r in ManagedModel(Failing()).answers(prompts, "x").collect())


def test_settings():
    assert settings_hash(settings_of()) == settings_hash(settings_of({})) != settings_hash(settings_of({"seed": 1}))
    assert settings_of({"sample": {"n": 3}})["sample"]["depth"] == 0.6
    with pytest.raises(ValueError, match="unknown"):
        settings_of({"sed": 1})
