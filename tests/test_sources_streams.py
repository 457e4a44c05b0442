import json

import pytest

from lodestone.plans import artifacts
from lodestone.plans.durable import durable
from lodestone.plans.model import BudgetExceeded, ManagedModel, ScriptedModel
from lodestone.sources import search
from lodestone.sources.adapter import analyze_corpus, infer_spec
from lodestone.sources.corpus import ExtractionSpec, extract_documents, read_corpus, sample_files, spec_is_usable
from lodestone.sources.search import SourceError
from lodestone.streaming.latest import append_versions, read_latest, windowed_counts

SPECS = [
    (ExtractionSpec("jsonl", join_dict_field="pages"), '{"pages":{"10":" ten ","1":"one","2":"","3":4}}\nnot json\n{"pages":["a"]}\n', ["one\nten"]),
    (ExtractionSpec("jsonl", ("meta.parts.1", "abstract")), '{"meta":{"parts":["x"," second "]}}\r\n{"abstract":"whole","meta":1}\n{"abstract":7}\n" alone "', ["second", "whole", "alone"]),
    (ExtractionSpec("csv", ("note",), delimiter=";"), 'k;note\n1;"first; line\ngoes on"\n2;\n3;third', ["first; line\ngoes on", "third"]),
    (ExtractionSpec("json", join_list_field="lines"), '{"lines":["p",3,"  ","q"]}', ["p\nq"]),
    (ExtractionSpec("json", ("v",)), '[{"v":"one"},{"v":" "},5,{"v":["two","three"]},{"v":{"b":"B","a":"A"}}]', ["one", "two\nthree", "A\nB"]),
    (ExtractionSpec("text"), "\n all of it\t", ["all of it"]),
    (ExtractionSpec("json", ("v",)), "{broken", []),
]


@pytest.mark.parametrize(("spec", "raw", "want"), SPECS)
def test_records(spark, spec, raw, want):
    files = spark.createDataFrame([("f", raw)], "path string, raw string")
    assert [r.text for r in extract_documents(files, spec).orderBy("doc_no").collect()] == want


def test_specs():
    spec = ExtractionSpec.of({"format": "csv", "text_fields": ["a"], "delimiter": ";"})
    assert spec == ExtractionSpec("csv", ("a",), delimiter=";") and ExtractionSpec.of(json.loads(spec.json())) == spec
    for bad in ({"format": "csv", "columns": []}, {"format": "xml"}):
        with pytest.raises(ValueError, match="xml|columns"):
            ExtractionSpec.of(bad)


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text(" plain text of some length ")
    (tmp_path / "z.md").write_bytes(b"with \0 and \xff bytes")
    (tmp_path / "sub/b.jsonl").write_text('{"content": "from json"}\nnot json\n{"ocr": {"2": "y", "1": "x"}}\n"a string"\n{"text": ["in", "a list"], "body": "the body"}\n[1]\n')
    (tmp_path / "c.bin").write_bytes(b"\0\1")
    (tmp_path / "d.log").write_text("a log file with enough text")
    (tmp_path / "e.dat").write_bytes(b"\xff\xfe not utf-8")
    docs = read_corpus(spark, f"file://{tmp_path}")
    assert sorted(r.text for r in docs.collect()) == ["from json", "plain text of some length", "the body", "with \0 and \ufffd bytes", "x\ny"]
    assert spec_is_usable(docs, 2) and not spec_is_usable(docs, 3)
    assert [r.ending for r in sample_files(spark, f"file://{tmp_path}").collect()] == ["txt", "log", "jsonl"]
    assert len(read_corpus(spark, f"file://{tmp_path}", ExtractionSpec("text")).collect()) == 6
    lines = read_corpus(spark, f"file://{tmp_path}/sub", ExtractionSpec("jsonl", ("content", "body"))).orderBy("doc_no").collect()
    assert [r.text for r in lines] == ["from json", "a string", "the body"]


def test_inferred_specs(spark):
    samples = {"a.jsonl": json.dumps({"doc": {"main": "a text of more than twenty characters"}}), "b.jsonl": json.dumps({"other": 1})}
    good = ExtractionSpec("jsonl", ("doc.main",))
    asked = []

    class Model(ScriptedModel):
        def complete(self, prompt):
            asked.append(prompt)
            return super().complete(prompt)

    model = lambda script, default: ManagedModel(Model(script, default))
    assert infer_spec(spark, samples, model({}, good.json())) == good and "a.jsonl" in asked[0]
    retried = model({"found text in 0 of 2": good.json()}, ExtractionSpec("jsonl", ("nowhere",)).json())
    assert infer_spec(spark, samples, retried) == good
    assert infer_spec(spark, samples, model({}, ExtractionSpec("jsonl", ("nowhere",)).json())) is None
    assert infer_spec(spark, samples, model({}, "no idea")) is None and infer_spec(spark, {}, model({}, "x")) is None
    assert analyze_corpus(spark, "nowhere", None) is None


def fetch_of(replies, log=None):
    def fetch(url, body, headers):
        for key, reply in replies.items():
            if key in url:
                if isinstance(reply, Exception):
                    raise reply
                return reply
        raise SourceError("no such place")

    return fetch


PREPRINTS = b'''<feed xmlns="http://www.w3.org/2005/Atom"><entry><id> http://p/1 </id><title>On
  bread</title><summary> Much   is said. </summary></entry></feed>'''
REPLIES = {
    "tavily": json.dumps({"results": [{"url": "http://w/1", "title": "W", "content": "c" * 900}, {"url": "http://w/2"}]}).encode(),
    "github": json.dumps({"items": [{"html_url": "http://g/1", "full_name": "a/b", "description": None, "license": {"spdx_id": "MIT"}}, {"html_url": "http://g/2", "license": {"spdx_id": "NOASSERTION"}}]}).encode(),
    "arxiv": PREPRINTS,
}


def test_services(monkeypatch):
    monkeypatch.setenv("TAVILY_API_KEY", "k")
    fetch = fetch_of(REPLIES)
    assert [(m["uri"], len(m["snippet"]), m["license"]) for m in search.web(["q", "r"], 3, fetch)] == [("http://w/1", 500, "unknown"), ("http://w/2", 0, "unknown"), ("http://w/1", 500, "unknown")]
    assert [(m["title"], m["license"]) for m in search.github(["q"], 9, fetch)] == [("a/b", "mit"), ("", "unknown")]
    assert search.arxiv(["q"], 1, fetch) == [{"uri": "http://p/1", "title": "On bread", "snippet": "Much is said.", "license": None}]
    for service, reply in ((search.web, b"<html>blocked"), (search.github, b"x"), (search.arxiv, b"{}")):
        with pytest.raises(SourceError):
            service(["q"], 1, fetch_of({"": reply}))
    monkeypatch.delenv("TAVILY_API_KEY")
    with pytest.raises(SourceError, match="TAVILY_API_KEY"):
        search.web(["q"], 1, fetch)
    with pytest.raises(ValueError, match="known"):
        search.check_sources(["local", "nowhere"])


def test_requests_to_services(spark):
    requests = spark.createDataFrame([("r1", ["q"], 2), ("r2", ["q"], 1)], "request_id string, queries array<string>, budget int")
    found = durable(search.ask_service(requests, "github", fetch_of(REPLIES)).unionByName(search.ask_service(requests, "arxiv", fetch_of({}))), "found")
    assert sorted((r.request_id, r.uri) for r in search.answered(found).collect()) == [("r1", "http://g/1"), ("r1", "http://g/2"), ("r2", "http://g/1")]
    with pytest.raises(SourceError, match="no such place"):
        search.answered(durable(search.ask_service(requests, "arxiv", fetch_of({})), "found"))
    none = durable(search.ask_service(requests, "github", fetch_of({"": b"{}"})), "found")
    assert search.answered(none).collect() == []


def test_artifacts(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    for i, at in (("a", "2"), ("b", "1")):
        artifacts.upsert(spark.createDataFrame([(i, at, None, "h", "{}", "{}")], artifacts.RUN), path)
    artifacts.finish_run(spark, path, "a", stage_stats='{"n": 1}')
    rows = artifacts.load(spark, path, "run_id", order="started_at").collect()
    assert [(r.run_id, r.finished_at is None, r.stage_stats) for r in rows] == [("b", True, "{}"), ("a", False, '{"n": 1}')]
    assert artifacts.load(spark, path, "run_id", ids=[]).collect() == [] and len(artifacts.load(spark, path, "run_id", ids=["b"], where={"settings_hash": "h"}).collect()) == 1
    with pytest.raises(ValueError, match="unknown run"):
        artifacts.finish_run(spark, path, "z")


def test_budgets_and_retries():
    m = ManagedModel(ScriptedModel({"x": "1"}, cost=0.5), max_cost=1.0)
    assert [m.complete("x1"), m.complete("y"), m.complete("x1")] == ["1", "{}", "1"]
    with pytest.raises(BudgetExceeded):
        m.complete("z")

    class Timeout(Exception):
        pass

    class Flaky(ScriptedModel):
        tries = 0

        def complete(self, prompt):
            self.tries += 1
            if self.tries < 3:
                raise Timeout
            return super().complete(prompt)

    waits = []
    assert ManagedModel(Flaky(), sleep=waits.append).complete("p") == "{}" and waits == [20.0, 40.0]
    with pytest.raises(Timeout):
        ManagedModel(Flaky(), retries=1, sleep=waits.append).complete("p")


def test_streams(spark, tmp_path):
    for k, rows in enumerate(([(1, "a", 1), (2, "b", 1)], [(3, "a", 2), (4, "c", 5)])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{k}.json").write_text("\n".join(json.dumps({"seq": s, "key": x, "v": v}) for s, x, v in rows))
    stream = spark.readStream.schema("seq long, key string, v long").option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in")
    append_versions(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "key", "seq").awaitTermination(60)
    assert sorted(tuple(r) for r in read_latest(spark, f"file://{tmp_path}/out", "key", "seq").select("key", "seq", "v").collect()) == [("a", 3, 2), ("b", 2, 1), ("c", 4, 5)]
    events = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double, props string").parquet("file:///root/testdata/sf0.001/events.parquet*")
    q = windowed_counts(events).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(n) from counts").first()[0] == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
