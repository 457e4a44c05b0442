"""Main text of web pages: gradient-boosted trees over DOM nodes with hierarchical decoding.

A page is parsed into a tree of block elements and of runs of inline content. Each node has features of its own and of its
surroundings: kind of tag, attribute tokens, depth, size and density of its subtree (links, signs, sentences), places among its
siblings, and its parent's and ancestors' marks. Boosted trees give the probability that a node holds main text. Decoding picks
the most probable labelling of the whole tree in which nothing below a dropped node is kept, by dynamic programming from the
leaves; kept runs are the blocks. The trees are trained here in numpy on generated pages whose main text is known (a seeded
generator of layouts, so that every session has the same model); no page of the input is a training page.

Null html is an empty page, and a page without main text has an empty text. Elements deeper than MAX_DEPTH are flattened: their
text belongs to the element at that depth, and their end tags close nothing else. Text is left out before the trees only inside
elements that never show text of the page (SILENT), whose ends are found as browsers find them where the end tag may be missing. Repeated rows come back once each. An empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, byte_slices

MAX_DEPTH = 200
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of a page.
SILENT = frozenset("script style head title noscript template iframe svg canvas audio video select option textarea button datalist".split())
_HEAD_CONTENT = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
INLINE = frozenset("math mi mn mo ms mrow msup msub msubsup mfrac msqrt mroot mtext mover munder semantics a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
#: What an opening tag closes, up to the nearest of the second set.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_SCOPES = frozenset("table td th article section div main aside nav header footer form blockquote ul ol li body html".split())
#: Where the search for what an end tag closes ends.
_CELLS = frozenset("table td th caption".split())
_END_LIMITS = {"li": frozenset("ul ol menu table td th".split()), **{t: frozenset(["table"]) for t in "tr td th thead tbody tfoot caption".split()}, "table": frozenset(), "html": frozenset(), "body": frozenset()}
TAGS = ("article main section div p li ul ol h1 h2 h3 h4 h5 h6 blockquote pre table tr td nav header footer aside form figure figcaption dl dt dd body html details address #run").split()
#: Attribute tokens, by what they say.
WORDS = {
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo banner adsense outbrain taboola",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc",
    "foot": "footer foot copyright legal colophon bottom",
    "head": "header masthead head logo top hero",
    "side": "sidebar side aside widget widgets rail related recommended popular trending more tags",
    "talk": "comment comments reply replies respond disqus discussion responses reader",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup banner warning disclaimer",
    "share": "share social sharing follow print byline meta author",
    "body": "article content post entry story main body text page prose",
}
_KINDS = list(WORDS)
_OF_WORD = {w: 1 << i for i, k in enumerate(_KINDS) for w in WORDS[k].split()}
_SPLIT = re.compile(r"[^a-z]+")


class Node:
    __slots__ = ("tag", "marks", "parent", "children", "text", "links", "depth")

    def __init__(self, tag: str, marks: int, parent: Node | None):
        self.tag, self.marks, self.parent, self.children = tag, marks, parent, []
        self.text: list[str] = []
        self.links = 0
        self.depth = parent.depth + 1 if parent else 0


class Builder(HTMLParser):
    """Block elements and runs; inline tags belong to the run that they are in.

    Silence is a stack of what is open inside a silent element. It ends with that element: at its end tag, where its end tag is
    implied (head, option, optgroup, select, button), or at the end tag of an element around it. Elements deeper than MAX_DEPTH are
    counted by name, so that their end tags close them and no element around them; their text stays in the deepest one above.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", 0, None)
        self.at, self.run, self.anchors = self.root, None, 0
        self.silent: list[str] = []
        self.deep: list[str] = []
        self.deep_names: Counter[str] = Counter()

    def _hush(self, tag: str) -> bool:
        """Takes a start tag inside silence; False if the silence ends before it."""
        if tag == "body" or (self.silent == ["head"] and tag not in _HEAD_CONTENT) or (tag in ("input", "textarea", "select") and self.silent[0] == "select") or (tag == "button" and self.silent[0] == "button"):
            self.silent = []
            return False
        while tag in ("option", "optgroup") and len(self.silent) > 1 and self.silent[-1] in ("option", tag):
            self.silent.pop()
        if tag == "option" and self.silent == ["option"]:
            return True
        if tag not in VOID:
            self.silent.append(tag)
        return True

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent and self._hush(tag):
            return
        if tag in SILENT:
            self.silent = [tag]
            return
        if tag in INLINE:
            if tag == "a":
                self.anchors = 1
            elif tag == "br":
                self.handle_data(" ")
            return
        self.run, self.anchors = None, 0
        if tag in VOID or tag in ("html", "body"):
            return
        if self.deep:
            self._sink(tag)
            return
        closes, scope = _CLOSES.get(tag, (frozenset(), _SCOPES))
        closes = closes or {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
        node = self.at
        while node.parent and node.tag not in scope:
            if node.tag in closes:
                self.at = node.parent
                if tag not in _CLOSES:
                    break
            node = node.parent
        if self.at.depth >= MAX_DEPTH:
            self._sink(tag)
            return
        marks = 0
        for k, v in attrs:
            if v and k in ("class", "id", "role", "aria-label", "itemprop"):
                for w in _SPLIT.split(v.lower()):
                    marks |= _OF_WORD.get(w, 0)
        node = Node(tag, marks, self.at)
        self.at.children.append(node)
        self.at = node

    def _sink(self, tag: str) -> None:
        self.deep.append(tag)
        self.deep_names[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID or tag in INLINE:
            self.handle_starttag(tag, attrs)
        elif not self.silent and tag not in SILENT:
            self.run = None

    def _opened(self, tag: str) -> Node | None:
        """The element that an end tag closes."""
        limits = _END_LIMITS.get(tag, _CELLS)
        node = self.at
        while node.parent and node.tag != tag:
            if node.tag in limits:
                return None
            node = node.parent
        return node if node.parent else None

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
                return
            if tag in INLINE or not (tag in ("body", "html") or self.deep_names[tag] or self._opened(tag)):
                return
            self.silent = []
        if tag in INLINE:
            if tag == "a":
                self.anchors = 0
            return
        self.run = None
        if self.deep_names[tag]:
            while True:
                last = self.deep.pop()
                self.deep_names[last] -= 1
                if last == tag:
                    return
        node = self._opened(tag)
        if node:
            self.at, self.anchors = node.parent, 0
            self.deep, self.deep_names = [], Counter()

    def handle_data(self, data: str) -> None:
        if self.silent == ["head"] and data.strip():
            self.silent = []
        if self.silent or not data:
            return
        if self.run is None:
            if data.isspace():
                return
            self.run = Node("#run", 0, self.at)
            self.at.children.append(self.run)
        self.run.text.append(data)
        if self.anchors:
            self.run.links += len(data.strip())


def parse(html: str) -> list[Node]:
    """The page's nodes, parents first, in page order."""
    builder = Builder()
    builder.feed(html)
    builder.close()
    out, stack = [], [builder.root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_HEAVY = re.compile(r"[.!?。！？]")


def features(nodes: list[Node]) -> np.ndarray:
    index = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    up = np.array([index[id(x.parent)] if x.parent else 0 for x in nodes])
    own = np.zeros((n, 5))  # characters, characters in links, sentence ends, words, runs
    for i, x in enumerate(nodes):
        if x.tag == "#run":
            text = "".join(x.text)
            own[i] = len(text.strip()), x.links, len(_HEAVY.findall(text)), len(text.split()), 1
    sums, count = own.copy(), np.ones(n)
    for i in range(n - 1, 0, -1):
        sums[up[i]] += sums[i]
        count[up[i]] += count[i]
    tag = np.array([_TAG_AT.get(x.tag, len(TAGS)) for x in nodes])
    marks = np.array([x.marks for x in nodes])
    above = np.zeros(n, np.int64)
    above_tags = np.zeros(n, np.int64)
    loud = {t: 1 << i for i, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "main"))}
    for i in range(1, n):
        above[i] = above[up[i]] | marks[up[i]]
        above_tags[i] = above_tags[up[i]] | loud.get(nodes[up[i]].tag, 0)
    siblings = np.array([len(x.parent.children) if x.parent else 1 for x in nodes])
    place = np.zeros(n)
    same = np.zeros(n)
    for x in nodes:
        tags = Counter(c.tag for c in x.children)
        for k, c in enumerate(x.children):
            place[index[id(c)]] = k
            same[index[id(c)]] = tags[c.tag]
    total = max(1.0, sums[0, 0])
    chars = np.maximum(sums[:, 0], 1)
    seen = np.cumsum(own[:, 0]) - own[:, 0]
    cols = [
        tag, tag[up], np.log1p(sums[:, 0]), sums[:, 1] / chars, sums[:, 2] / np.maximum(sums[:, 3], 1), np.log1p(sums[:, 3]), sums[:, 0] / np.maximum(sums[:, 4], 1),
        sums[:, 0] / count, sums[:, 0] / total, sums[up, 0] / total, sums[up, 1] / chars[up], np.array([x.depth for x in nodes]), place, siblings - place, same, seen / total,
        sums[:, 4], np.minimum(siblings, 50), np.log1p(sums[up, 0]), sums[up, 4], count[up] / np.maximum(sums[up, 4], 1),
    ]
    cols += [(marks >> i) & 1 for i in range(len(_KINDS))] + [(above >> i) & 1 for i in range(len(_KINDS))] + [(above_tags >> i) & 1 for i in range(len(loud))]
    cols += [(tag == _TAG_AT[t]).astype(float) for t in ("nav", "header", "footer", "aside", "form", "article", "#run", "div", "section")]
    return np.column_stack(cols).astype(np.float32)


class Boosted:
    """Boosted regression trees of the logistic loss on binned features."""

    def __init__(self, rounds: int = 50, depth: int = 5, rate: float = 0.25, bins: int = 32, least: float = 3.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)])
        self.trees, logit = [], np.zeros(len(y))
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-logit))
            g, h = (y - p) * weight, p * (1 - p) * weight
            size = 2 ** (self.depth + 1)
            split, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            at = np.ones(len(y), np.int64)
            for level in range(self.depth + 1):
                for node in range(2**level, 2 ** (level + 1)):
                    rows = np.flatnonzero(at == node)
                    if not len(rows):
                        continue
                    gs, hs = g[rows].sum(), h[rows].sum()
                    value[node] = self.rate * gs / (hs + 1)
                    if level == self.depth or hs < self.least:
                        continue
                    key = binned[rows] + np.arange(x.shape[1]) * self.bins
                    gb = np.bincount(key.ravel(), np.repeat(g[rows], x.shape[1]), x.shape[1] * self.bins).reshape(-1, self.bins).cumsum(1)
                    hb = np.bincount(key.ravel(), np.repeat(h[rows], x.shape[1]), x.shape[1] * self.bins).reshape(-1, self.bins).cumsum(1)
                    gain = gb**2 / (hb + 1) + (gs - gb) ** 2 / (hs - hb + 1) - gs**2 / (hs + 1)
                    gain[(hb < 1) | (hs - hb < 1)] = 0
                    j, b = np.unravel_index(gain.argmax(), gain.shape)
                    if gain[j, b] <= 1e-6:
                        continue
                    split[node], cut[node] = j, b
                    at[rows] = 2 * node + (binned[rows, j] > b)
            logit += value[at]
            self.trees.append((split, cut, value))
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)])
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for split, cut, value in self.trees:
            at = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                j = split[at]
                at = np.where(j >= 0, 2 * at + (binned[rows, j] > cut[at]), at)
            out += value[at]
        return out


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """The labelling with the highest likelihood in which no node below a dropped one is kept; a run counts double."""
    index = {id(n): i for i, n in enumerate(nodes)}
    weight = np.array([2.0 if x.tag == "#run" else 1.0 for x in nodes])
    keep, drop = -np.logaddexp(0, -logit) * weight, -np.logaddexp(0, logit) * weight
    best_keep, all_drop = keep.copy(), drop.copy()
    for i in range(len(nodes) - 1, 0, -1):
        up = index[id(nodes[i].parent)]
        all_drop[up] += all_drop[i]
        best_keep[up] += max(best_keep[i], all_drop[i])
    kept = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        kept[i] = (x.parent is None or kept[index[id(x.parent)]]) and best_keep[i] > all_drop[i]
    return kept


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    """The trees see the nodes of all pages at once."""
    parsed = [parse(x) for x in pages]
    if not parsed:
        return []
    logit, out, at = model.logit(np.concatenate([features(x) for x in parsed])), [], 0
    for nodes in parsed:
        kept = decode(nodes, logit[at : at + len(nodes)]).tolist()
        at += len(nodes)
        blocks = (" ".join("".join(x.text).split()) for x, k in zip(nodes, kept, strict=True) if k and x.tag == "#run")
        out.append("\n\n".join(b for b in blocks if b))
    return out


def main_text(html: str, model: Boosted) -> str:
    return main_texts([html], model)[0]


class Pages:
    """A seeded generator of pages with known main text: each text run is main text if and only if it has the mark KEPT at its start."""

    KEPT = ""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.words = ["".join(self.r.choices(["an", "th", "er", "on", "re", "le", "de", "que", "ung", "ch", "o", "a", "ti", "mi", "ô", "ß"], k=self.r.randint(1, 5))) for _ in range(400)]

    def prose(self, least: int = 3, most: int = 90) -> str:
        n = self.r.randint(least, self.r.choice([min(most, 12), most, most]))
        out, left = [], 0
        for _ in range(n):
            w = self.r.choice(self.words)
            if left <= 0:
                left, w = self.r.randint(1, 14), w.capitalize()
                if out:
                    out[-1] += self.r.choice(".....!?")
            left -= 1
            out.append(w)
        return " ".join(out) + self.r.choice([".", ".", ".", "", "!"])

    def few(self, most: int = 6) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(1, most))).capitalize()

    def links(self) -> str:
        items = [f"<a href='/{i}'>{self.few(4)}</a>" for i in range(self.r.randint(2, 12))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.7 else self.r.choice([" | ", " "]).join(items)

    def named(self, tags: str, names: str, inner: str, plain: float = 0.2) -> str:
        tag = self.r.choice(tags.split())
        name = "" if self.r.random() < plain and tag != "div" else self.r.choice([" class='{}'", ' id="{}"', ' class="x {} y"']).format(self.r.choice(names.split()))
        return f"<{tag}{name}>{inner}</{tag}>"

    def clutter(self) -> str:
        r, roll = self.r, self.r.random()
        if roll < 0.18:
            return self.named("nav nav div", "nav main-nav menu navbar breadcrumb", self.links())
        if roll < 0.4:
            return self.named("div div aside section", "ad ads advert sponsored promo ad-box", self.prose(2, 25) if r.random() < 0.7 else f"<p>{self.prose(2, 30)}</p>")
        if roll < 0.52:
            return self.named("aside aside div", "sidebar related widget popular", f"<h3>{self.few()}</h3>" * r.randint(0, 1) + (self.links() if r.random() < 0.6 else f"<p>{self.prose(3, 60)}</p>"))
        if roll < 0.64:
            return self.named("div div section aside", "cookie-notice consent alert notice newsletter popup", f"<p>{self.prose(4, 40)}</p>" if r.random() < 0.6 else self.prose(4, 40), 0)
        if roll < 0.76:
            return f"<form action='/s'><p>{self.prose(2, 12)}</p><label>{self.few(3)}</label><input type='text'><button>{self.few(2)}</button></form>"
        if roll < 0.88:
            return self.named("div div ul", "share social tags byline meta", self.links())
        return self.comments()

    def wrapped(self, inner: str) -> str:
        """Inside plain elements, as builders of pages nest them."""
        n = self.r.choice([self.r.randint(1, 4), self.r.randint(3, 12), self.r.randint(5, 40)])
        tags = self.r.choices(["div", "div", "div", "section"], k=n)
        return "".join(f"<{t}>" for t in tags) + inner + "".join(f"</{t}>" for t in reversed(tags))

    def comments(self) -> str:
        one = lambda: self.named("li div article", "comment reply comment-body", f"<p><b>{self.few(2)}</b></p>" * self.r.randint(0, 1) + f"<p>{self.prose(3, 70)}</p>", 0)
        return self.named("section div ol div", "comments comment-list discussion responses", f"<h3>{self.few(3)}</h3>" * self.r.randint(0, 1) + "".join(one() for _ in range(self.r.randint(1, 6))), 0)

    def block(self, paragraphs: float = 0.6) -> str:
        r, roll, k = self.r, self.r.random(), self.KEPT
        if roll < paragraphs:
            inner = self.prose() if r.random() < 0.85 else self.prose(1, 4)
            if r.random() < 0.3:
                inner = f"<b>{k}{inner}</b> {self.prose(1, 20)}"
            elif r.random() < 0.3:
                inner = f"{k}{inner} <a href='/x'>{self.few()}</a> {self.prose(1, 20)}"
            else:
                inner = k + inner
            return f"<p>{inner}" + "</p>" * (r.random() < 0.8) if r.random() < 0.92 else f"<p>{inner}<br>"
        if roll < 0.72:
            h = r.choice(["h2", "h3", "h4"])
            return f"<{h}>{k}{self.few(8)}</{h}>"
        if roll < 0.8:
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{k}{self.prose(2, 25)}</li>" for _ in range(r.randint(1, 6))) + f"</{tag}>"
        if roll < 0.86:
            return f"<blockquote>{k}{self.prose()}</blockquote>" if r.random() < 0.5 else f"<blockquote><p>{k}{self.prose()}</p></blockquote>"
        if roll < 0.9:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{k}{self.few(3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if roll < 0.94:
            return f"<figure><img src=x><figcaption>{k}{self.few(9)}</figcaption></figure>"
        if roll < 0.97:
            return f"<pre>{k}{self.prose(3, 30)}</pre>"
        return f"<div>{k}{self.prose()}</div>"

    def page(self) -> str:
        r, k = self.r, self.KEPT
        plain = r.choice([0.6, 0.6, 1.0])
        body = [self.block(plain) for _ in range(r.choice([r.randint(1, 16), r.randint(1, 16), r.randint(10, 80)]))]
        if r.random() < 0.2:
            body = [self.wrapped(x) if r.random() < 0.3 else x for x in body]
        title = self.few(14)
        if r.random() < 0.85:
            heading = f"<h1>{k}{title}</h1>"
            body.insert(0, heading if r.random() < 0.8 else f"<header>{heading}</header>")
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            body.insert(r.randint(0, len(body)), self.clutter())
        main = "".join(body)
        wrap = r.random()
        if wrap < 0.5:
            main = f"<article>{main}</article>" if r.random() < 0.7 else self.named("article", "post entry story", main)
        elif wrap < 0.65:
            main = f"<main>{main}</main>"
        elif wrap < 0.92:
            main = self.named("div section", "content article-body post entry main-content story", main, 0)
        else:
            main = f"<div>{main}</div>"
        if r.random() < 0.3:
            main = self.named("div main section", "page content wrapper container", main + "".join(self.clutter() for _ in range(r.choice([0, 1]))))
        if r.random() < 0.25:
            main = self.named("main div", "main wrap layout", self.clutter() * r.randint(0, 1) + main, 0.5)
        if r.random() < 0.2:
            main = self.wrapped(main)
        top = [self.named("nav", "menu", self.links(), 0.7)] if r.random() < 0.6 else []
        if r.random() < 0.5:
            top.append(self.named("header div", "header masthead top site-header", f"<h1>{self.few(3)}</h1>" * r.randint(0, 1) + (self.links() if r.random() < 0.6 else self.few()), 0.5))
        top += [self.clutter() for _ in range(r.choice([0, 1, 1, 2]))]
        r.shuffle(top)
        end = [self.clutter() for _ in range(r.choice([0, 0, 1, 2]))]
        if r.random() < 0.3:
            end.append(self.comments())
        foot = self.named("footer footer div", "footer site-footer copyright", r.choice([f"&copy; {self.few(3)} &middot; {self.prose(3, 25)}", self.links(), f"<p>{self.prose(4, 30)}</p>"]), 0.8)
        if r.random() < 0.85:
            end.append(foot)
        return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{''.join(top)}{main}{''.join(end)}</body></html>"


@lru_cache(1)
def trained(pages: int = 800, seed: int = 7) -> Boosted:
    make, xs, ys = Pages(seed), [], []
    for _ in range(pages):
        nodes = parse(make.page())
        index = {id(n): i for i, n in enumerate(nodes)}
        y = np.array([float(x.tag == "#run" and Pages.KEPT in "".join(x.text)) for x in nodes])
        for x in nodes:
            x.text = [t.replace(Pages.KEPT, "") for t in x.text]
        for i in range(len(nodes) - 1, 0, -1):
            up = index[id(nodes[i].parent)]
            y[up] = max(y[up], y[i])
        xs.append(features(nodes))
        ys.append(y)
    y = np.concatenate(ys)
    return Boosted().fit(np.concatenate(xs), y, np.ones(len(y)))


def _extract(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in byte_slices(batch, "html", 1_000_000):
            texts = main_texts([x.decode("utf-8", "replace") for x in as_bytes(rows.column("html"))], model.value)
            keep = [c for c in rows.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url and text of each page."""
    model = pages.sparkSession.sparkContext.broadcast(trained())
    pages = pages.select("page_id", "url", "html")
    schema = pages.drop("html").withColumn("text", F.lit("")).schema
    return pages.mapInArrow(partial(_extract, model=model), schema)
