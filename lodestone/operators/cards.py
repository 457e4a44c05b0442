"""Cards of a concept graph: what it holds, caveats that follow from its state, and its history of revisions."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.graph import card_stats, live

#: Revisions that a card keeps.
HISTORY = 50


@dataclass
class Card:
    name: str
    revision: int = 1
    created_at: str = ""
    updated_at: str = ""
    settings_hash: str = ""
    build: dict = field(default_factory=dict)
    stats: dict = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)
    history: list[dict] = field(default_factory=list)

    @classmethod
    def read(cls, values: object) -> Card | None:
        """None if the values aren't a card's."""
        try:
            return cls(**values)
        except TypeError:
            return None


def stats(nodes: DataFrame, edges: DataFrame, flags: DataFrame | None = None) -> dict:
    """Counts of a graph; a row for each level, status and root comes to the driver."""
    levels = {r.level: r for r in card_stats(nodes, edges).collect()}
    status = {r.status: r.n for r in live(nodes).groupBy("status").agg(F.count("*").alias("n")).collect()}
    order = "ord" if "ord" in nodes.columns else "id"
    seeds = [r.label for r in live(nodes).where("level = 0").orderBy(order).select("label").collect()]
    return {
        "nodes": sum(r.n_nodes for r in levels.values()), "edges": edges.count(), "levels": {str(k): levels[k].n_nodes for k in sorted(levels)}, "max_level": max(levels, default=0), "status": status, "seeds": seeds,
        "described": {str(k): f"{levels[k].n_described}/{levels[k].n_nodes}" for k in sorted(levels)}, "nodes_with_materials": sum(r.n_with_materials for r in levels.values()), "review_flags": flags.count() if flags is not None else 0,
    }


def notes(found: dict, build: dict) -> list[str]:
    out = []
    if found["max_level"]:
        out.append(f"Nodes of level {found['max_level']} are the ends of the graph and have no descriptions by design; use their labels and paths.")
    if found["nodes"] and not found["nodes_with_materials"]:
        out.append("No node has a count of materials: nothing was retrieved yet. That doesn't say that there are none.")
    if found["review_flags"]:
        out.append(f"{found['review_flags']} cases wait for review.")
    out.append("Built with " + ", ".join(f"{k} {v}" for k, v in sorted(build.items())) + ".")
    return out


def revised(old: Card | None, name: str, found: dict, build: dict, settings_hash: str, now: str) -> Card:
    """The card after a build: the old one itself if nothing changed, else its next revision; a new name alone is a revision too."""
    if old and old.stats == found and old.build == build and old.name == name:
        return old
    before = old.stats if old else {"nodes": 0, "edges": 0}
    renamed = old is not None and old.stats == found and old.build == build
    event = {"at": now, "nodes": found["nodes"], "edges": found["edges"], "delta_nodes": found["nodes"] - before["nodes"], "delta_edges": found["edges"] - before["edges"], "note": "initial" if old is None else "renamed" if renamed else "updated"}
    return Card(name, old.revision + 1 if old else 1, old.created_at if old else now, now, settings_hash, build, found, notes(found, build), [*(old.history if old else []), event][-HISTORY:])


def card_json(card: Card) -> dict:
    return asdict(card)


def card_text(card: Card) -> str:
    """The card in Markdown."""
    s = card.stats
    facts = [
        ("nodes, edges", f"{s['nodes']}, {s['edges']}"), ("levels", ", ".join(f"{k}: {v}" for k, v in s["levels"].items())), ("roots", ", ".join(s["seeds"])),
        ("described", ", ".join(f"{k}: {v}" for k, v in s["described"].items())), ("nodes with materials", s["nodes_with_materials"]), ("built", f"{card.created_at}, last {card.updated_at}"), ("settings", card.settings_hash),
    ]
    lines = [f"# {card.name}, revision {card.revision}", "", "| | |", "|---|---|", *[f"| {k} | {v} |" for k, v in facts], "", "## Notes", "", *[f"- {x}" for x in card.notes], "", "## History", ""]
    lines += ["| at | nodes | edges | more nodes | more edges | |", "|---|---:|---:|---:|---:|---|"]
    lines += [f"| {e['at']} | {e['nodes']} | {e['edges']} | {e['delta_nodes']:+d} | {e['delta_edges']:+d} | {e['note']} |" for e in card.history]
    return "\n".join(lines) + "\n"
