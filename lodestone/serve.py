"""A small web page over a run's work folder: its tables, the first rows of each, and a task with where it comes from."""

from __future__ import annotations

import html
import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession

from lodestone.operators import tasks
from lodestone.plans.run import Run

TABLES = ("nodes", "edges", "flags", "decisions", "bundles", "materials", "tasks", "verified", "runs")
#: Rows that a page shows.
SHOWN = 200


def _table(rows: DataFrame) -> str:
    cell = lambda x: html.escape(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False, default=str))
    head = "".join(f"<th>{html.escape(c)}</th>" for c in rows.columns)
    body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows.limit(SHOWN).collect())
    return f"<table><tr>{head}</tr>{body}</table>"


def page(run: Run, path: str) -> tuple[int, str]:
    """The status and the HTML of a path: /, /table/NAME, /tasks?type=&result=, /task/ID."""
    parts = urlsplit(path)
    asked = {k: v[0] for k, v in parse_qs(parts.query).items()}
    names = [t for t in TABLES if run.has(t)]
    links = " ".join(f"<a href='/table/{t}'>{t}</a>" for t in names) + (" <a href='/tasks'>tasks by type</a>" if "verified" in names else "")
    step = parts.path.strip("/").split("/")
    if step == [""]:
        return 200, f"<h1>{html.escape(run.settings['name'])}</h1>{links}"
    if step[0] == "table" and len(step) == 2 and step[1] in names:
        return 200, f"{links}<h1>{step[1]}</h1>{_table(run.read(step[1], 'run'))}"
    if step == ["tasks"] and "verified" in names:
        rows = tasks.labels_of(tasks.chosen(run.read("verified", "verify"), asked.get("type", "all"), asked.get("result", "all"))).orderBy("task_id")
        return 200, links + "".join(f"<p><a href='/task/{html.escape(r.task_id)}'>{html.escape(r.label)}</a>" for r in rows.limit(SHOWN).collect())
    if step[0] == "task" and len(step) == 2 and "verified" in names:
        found = tasks.detail(run.read("verified", "verify").where(f"task_id = '{step[1]}'")).collect() if step[1].replace("_", "").isalnum() else []
        if found:
            return 200, f"{links}<pre>{html.escape(found[0].text)}</pre><pre>{html.escape(found[0].provenance)}</pre>"
    return 404, f"{links}<p>nothing here"


def server(spark: SparkSession, settings: dict, host: str = "127.0.0.1", port: int = 7860) -> ThreadingHTTPServer:
    run = Run(spark, settings)

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body = page(run, self.path)
            raw = f"<!doctype html><meta charset=utf-8>{body}".encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
