"""python -m lodestone STAGE SETTINGS: one stage of a run, or all of them (`run`); the settings are a YAML or JSON file.

Besides: ingest (how the corpus is read), card, graph (--format dot or json), review (--queue all, parents or align), tasks (--type, --result),
serve (--host, --port).
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    from lodestone.api import load_graph
    from lodestone.operators.graph import dot_lines, json_lines, review
    from lodestone.operators.tasks import chosen, labels_of
    from lodestone.plans.run import STAGES, MissingStage, Run
    from lodestone.serve import server

    parser = argparse.ArgumentParser(prog="lodestone")
    parser.add_argument("stage", choices=[*STAGES, "run", "ingest", "card", "graph", "review", "tasks", "serve"])
    parser.add_argument("settings")
    parser.add_argument("--no-resume", action="store_true")
    parser.add_argument("--format", choices=["dot", "json"], default="dot")
    parser.add_argument("--queue", choices=["all", "parents", "align"], default="all")
    parser.add_argument("--type", default="all")
    parser.add_argument("--result", default="all")
    parser.add_argument("--host", default="127.0.0.1")
    parser.add_argument("--port", type=int, default=7860)
    own = parser.parse_args(argv)
    with open(own.settings, encoding="utf-8") as f:
        raw = f.read()
    if own.settings.endswith(".json"):
        settings = json.loads(raw)
    else:
        import yaml

        settings = yaml.safe_load(raw) or {}
    from pyspark.sql import SparkSession

    run = Run(SparkSession.builder.appName("lodestone").getOrCreate(), settings, resume=not own.no_resume)
    try:
        if own.stage == "graph":
            nodes, edges = run.nodes(), run.read("edges", "build")
            if own.format == "dot":
                print("digraph {", *[r.line for r in dot_lines(nodes, edges).toLocalIterator()], "}", sep="\n")
            else:
                print("\n".join(r.line for r in json_lines(nodes, edges).toLocalIterator()))
        elif own.stage == "review":
            found = [] if own.queue == "align" else [review(load_graph(run.spark, run.settings["workdir"])["flags"], own.queue)]
            # the first verdicts are enough for a look
            found += [run.read("decisions", "build").limit(50)] if own.queue != "parents" else []
            for rows in found:
                for r in rows.toLocalIterator():
                    print(json.dumps(r.asDict(), ensure_ascii=False))
        elif own.stage == "tasks":
            for r in labels_of(chosen(run.read("verified", "verify"), own.type, own.result)).orderBy("task_id").toLocalIterator():
                print(r.label)
        elif own.stage == "serve":
            server(run.spark, settings, own.host, own.port).serve_forever()
        elif own.stage == "card":
            print(run.card())
        else:
            print(json.dumps(run.all() if own.stage == "run" else getattr(run, own.stage)(), ensure_ascii=False))
    except MissingStage as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
