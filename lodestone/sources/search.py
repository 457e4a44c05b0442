"""Material sources: the local corpus and three search services, all asked by DataFrames of requests.

A request is (request_id, queries, budget). A service is a function (queries, budget, fetch) that gives materials; fetch(url, body,
headers) gives the reply's bytes and is the only thing that touches a network, so tests and offline runs bring their own. Services run
where the requests' partitions are; a service that fails gives a row with `error` set instead of materials. A failed source doesn't stop
the others; if no request of any source succeeded, the first error is raised.
"""

from __future__ import annotations

import json
import os
import ssl
import urllib.error
import urllib.parse
import urllib.request
import warnings
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fetch = Callable[[str, bytes | None, dict[str, str]], bytes]
Service = Callable[[list[str], int, Fetch], list[dict]]
SNIPPET = 500
#: The services' addresses and the name spaces of their replies.
WEB_URL, REPOSITORY_URL, PREPRINT_URL = "https://api.tavily.com/search", "https://api.github.com/search/repositories", "https://export.arxiv.org/api/query"
ATOM = "{http://www.w3.org/2005/Atom}"
MATERIAL = "request_id string, source_type string, uri string, title string, snippet string, license string, error string, ord bigint"


class SourceError(RuntimeError):
    pass


def url_fetch(url: str, body: bytes | None, headers: dict[str, str], *, verify: bool = True, timeout: float = 30.0) -> bytes:
    """Over the network. Without `verify` certificates aren't checked, with a warning."""
    context = ssl.create_default_context()
    if not verify:
        warnings.warn("certificates are not checked", stacklevel=2)
        context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers), timeout=timeout, context=context) as reply:
            return reply.read()
    except urllib.error.HTTPError as e:
        raise SourceError(f"HTTP {e.code} from {urllib.parse.urlsplit(url).netloc}") from e
    except OSError as e:
        raise SourceError(f"no reply from {urllib.parse.urlsplit(url).netloc}: {e}") from e


def _json(raw: bytes, name: str) -> dict:
    try:
        return json.loads(raw)
    except ValueError as e:
        head = raw[:80].decode("utf-8", "replace")
        raise SourceError(f"{name}: the reply isn't JSON, it starts with {head!r}; a proxy's page may be the cause") from e


def _until_enough(queries: list[str], budget: int, ask: Callable[[str, int], list[dict]]) -> list[dict]:
    """Query after query, until there are enough materials."""
    found: list[dict] = []
    for query in queries:
        if len(found) >= budget:
            break
        found += ask(query, budget - len(found))
    return found[:budget]


def web(queries: list[str], budget: int, fetch: Fetch, *, key_name: str = "TAVILY_API_KEY") -> list[dict]:
    key = os.environ.get(key_name)
    if not key:
        raise SourceError(f"web: set {key_name}, or leave the source out")

    def ask(query: str, n: int) -> list[dict]:
        body = json.dumps({"api_key": key, "query": query, "max_results": n}).encode()
        got = _json(fetch(WEB_URL, body, {"Content-Type": "application/json"}), "web")
        return [{"uri": x.get("url"), "title": x.get("title") or "", "snippet": (x.get("content") or "")[:SNIPPET], "license": "unknown"} for x in got.get("results") or []]

    return _until_enough(queries, budget, ask)


def github(queries: list[str], budget: int, fetch: Fetch) -> list[dict]:
    def ask(query: str, n: int) -> list[dict]:
        url = f"{REPOSITORY_URL}?{urllib.parse.urlencode({'q': query, 'per_page': n})}"
        got = _json(fetch(url, None, {"Accept": "application/vnd.github+json", "User-Agent": "lodestone"}), "github")
        out = []
        for x in got.get("items") or []:
            name = (x.get("license") or {}).get("spdx_id") or "NOASSERTION"
            out.append({"uri": x.get("html_url"), "title": x.get("full_name") or "", "snippet": (x.get("description") or "")[:SNIPPET], "license": "unknown" if name == "NOASSERTION" else name.lower()})
        return out

    return _until_enough(queries, budget, ask)


def arxiv(queries: list[str], budget: int, fetch: Fetch) -> list[dict]:
    def ask(query: str, n: int) -> list[dict]:
        url = f"{PREPRINT_URL}?{urllib.parse.urlencode({'search_query': f'all:{query}', 'start': 0, 'max_results': n})}"
        try:
            entries = ET.fromstring(fetch(url, None, {})).iter(f"{ATOM}entry")
        except ET.ParseError as e:
            raise SourceError(f"arxiv: the reply isn't XML: {e}") from e
        text = lambda entry, name: " ".join((entry.findtext(f"{ATOM}{name}") or "").split())
        return [{"uri": text(e, "id") or None, "title": text(e, "title"), "snippet": text(e, "summary")[:SNIPPET], "license": None} for e in entries]

    return _until_enough(queries, budget, ask)


SERVICES: dict[str, Service] = {"web": web, "github": github, "arxiv": arxiv}


def register_source(name: str, service: Service) -> None:
    SERVICES[name] = service


def check_sources(names: list[str]) -> list[str]:
    """The names, if each is `local` or a service's."""
    for name in names:
        if name != "local" and name not in SERVICES:
            raise ValueError(f"unknown source {name!r}; known: {sorted([*SERVICES, 'local'])}")
    return names


def _ask(frames: Iterator[pd.DataFrame], name: str, service: Service, fetch: Fetch) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples():
            try:
                found = service(list(r.queries), int(r.budget), fetch)
                rows += [{"request_id": r.request_id, "source_type": name, "error": None, "ord": i, **m} for i, m in enumerate(found)]
                rows += [] if found else [{"request_id": r.request_id, "source_type": name, "ord": -1}]
            except SourceError as e:
                rows.append({"request_id": r.request_id, "source_type": name, "error": str(e), "ord": -1})
        names = [x.split()[0] for x in MATERIAL.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"ord": "int64"}).astype(object).where(lambda x: x.notna(), None)


def ask_service(requests: DataFrame, name: str, fetch: Fetch = url_fetch) -> DataFrame:
    """Materials of a service for requests (request_id, queries, budget), with a row of ord -1 for each request without one."""
    if name not in SERVICES:
        raise ValueError(f"unknown source {name!r}; known: {sorted(SERVICES)}")
    return requests.select("request_id", "queries", "budget").mapInPandas(partial(_ask, name=name, service=SERVICES[name], fetch=fetch), MATERIAL)


def answered(found: DataFrame) -> DataFrame:
    """The materials; raises the first error if no request succeeded. `found` is a written table."""
    state = found.agg(F.count_if(F.col("error").isNull()).alias("good"), F.min_by("error", F.struct("source_type", "request_id")).alias("error")).first()
    if not state.good and state.error:
        raise SourceError(state.error)
    return found.where("ord >= 0").drop("error")
