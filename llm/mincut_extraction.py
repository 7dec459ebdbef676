"""Main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks: the text between two block-level tags, with the chain of open elements,
and how much of it is link text. Every block is a node. A logistic classifier gives the capacities to
the two terminals: -log of the probability of the label that the block would get on that side. What a
block's elements, ids and classes are called enters it with stated weights; the weights of the block's
form (length, links, sentence marks, heading, list) are fitted. Blocks that markup names without doubt,
as an article or as navigation, label their own form, so pages without such names profit from those
that have them. The fit is a Gaussian-prior logistic regression around stated weights. Blocks that
follow each other and blocks whose common element is near are joined by smoothness edges, whose
capacity falls with their distance in the page and in the tree. The maximum flow is pushed along
shortest augmenting paths; blocks that the content terminal still reaches are the main text.

What no reader sees (scripts, styles, comments, templates, the head, hidden elements) is not text and
forms no block. A class or id counts as a boilerplate name only if all of its words are such names or
words of layout: `share-buttons` does, `share-market` does not.

Defined results: a null or empty page, and one without blocks, has an empty text. Broken markup is read
as far as it goes: an element that is never closed, hidden or not, ends with its parent or the page (the
head with the first element of the body, a script or style with the page), an unfinished tag
at the end of the page is markup, an unfinished character reference stays as it is. Pages are
independent given the weights, so repeated rows get equal results. An empty table has the stated weights.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from llm.sampling import bounded_sample
from statbank.session import discard, materialized

#: Weight of smoothness: between neighbours in the page, and between blocks of one parent.
NEXT, SIBLING = 0.35, 0.5
#: Half as much for each step more between two blocks' common element and them.
PER_STEP = 0.5
#: Blocks further apart than this share no edge; smoothness reaches them through those between.
REACH = 3

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:>|(?=<)|\Z)|</?\Z", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Elements by how they are read (fixed values of HTML).
RAW = frozenset("script style textarea title iframe".split())
UNSEEN = frozenset("template noscript head select option svg math object canvas audio video datalist".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Text-holding elements that the next one of their kind, or any block, closes.
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
# What elements are called when they hold content or boilerplate, with the weight of the hint.
ELEMENTS = {
    "article": 2.5,
    "main": 1.5,
    "nav": -5.0,
    "header": -2.5,
    "footer": -5.0,
    "aside": -4.0,
    "form": -5.0,
    "button": -5.0,
    "menu": -4.0,
    "dialog": -5.0,
    "address": -1.0,
    "fieldset": -4.0,
}
GOOD_NAMES = frozenset("article content main post entry story body text articlebody prose".split())
BAD_NAMES = frozenset(
    (
        "nav navigation navbar menu menus header footer foot sidebar side aside ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
        "banner cookie cookies consent notice notices alert popup modal overlay gdpr newsletter subscribe subscription signup login comment comments commentlist reply "
        "replies disqus discussion respond form search share sharing social related recommended breadcrumb breadcrumbs pagination pager widget toolbar masthead copyright legal contentinfo complementary"
    ).split()
)
# Words of layout that may stand beside a boilerplate name.
LAYOUT_NAMES = frozenset(
    (
        "bar bars box boxes button buttons btn icon icons list lists link links block blocks wrap wrapper container content section panel pane area region inner outer item items slot unit group row col "
        "column grid left right top bottom upper lower main primary secondary global site page body post posts article articles story stories entry entries message msg text title heading label input field fields "
        "form thread count counter tools tool mobile desktop sticky fixed floating inline small large toggle open closed more by us me this on off the of and to for by id js module component"
    ).split()
)
_GOOD, _BAD = 1.5, -7.0
#: A block labels its form if its names say at least so much for content, or at most so much against it.
SURE, SURE_NOT = 1.5, -4.0
#: Pages and blocks of the fit, and how many blocks' worth of evidence stands against the prior.
PAGES, BLOCKS, EVIDENCE = 2_000, 20_000, 50.0
#: Stated weights of a block's form: constant, length, share of link text, sentence marks, heading, list.
PRIOR = (0.3, 1.0, -4.0, 0.4, 0.8, 0.3)


@dataclass(eq=False)
class Element:
    """An open element: its parent, its depth, the best hint for content down to here, the sum of hints against it."""

    name: str
    parent: Element | None
    depth: int = 0
    good: float = 0.0
    bad: float = 0.0
    hidden: bool = False
    listed: bool = False


@dataclass
class Block:
    text: str
    linked: int
    inside: Element

    @property
    def hints(self) -> float:
        return self.inside.good + self.inside.bad


def attributes(tag: str) -> dict[str, str]:
    """The attributes of a start tag; of equal names the first. A name without a value has ''."""
    out: dict[str, str] = {}
    for found in _ATTRIBUTE.finditer(tag, _NAME.match(tag).end()):
        out.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    return out


def _hidden(own: dict[str, str]) -> bool:
    return "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true" or bool(_NO_DISPLAY.search(own.get("style", "")))


def _hint(name: str, own: dict[str, str]) -> float:
    weight = ELEMENTS.get(name, 0.0)
    if name in ("body", "html"):
        return 0.0
    for key, value in own.items():
        if key not in ("class", "id", "role", "aria-label", "itemprop") and not key.startswith("data-"):
            continue
        good = bad = False
        for token in [value] if key == "aria-label" else value.split():
            words = set(_WORD.findall(_HUMP.sub("-", token).lower()))
            boilerplate = words & BAD_NAMES and words <= BAD_NAMES | LAYOUT_NAMES
            bad |= bool(boilerplate)
            good |= bool(words & GOOD_NAMES) and not boilerplate
        if bad and not (good and name in ("article", "main")):
            weight += _BAD
        elif good and not bad:
            weight += _GOOD
    return weight


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order. Time is linear in the page; depth is the number of open elements."""
    out: list[Block] = []
    stack = [Element("", None)]
    parts: list[tuple[str, bool]] = []
    links, at = 0, 0

    def flush() -> None:
        nonlocal parts
        if not parts:
            return
        text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
        if text:
            linked = len(_SPACE.sub(" ", html.unescape("".join(p for p, link in parts if link))).strip())
            out.append(Block(text, linked, stack[-1]))
        parts = []

    def close(depth: int) -> None:
        nonlocal links
        for element in stack[depth:]:
            links -= element.name == "a"
        del stack[depth:]

    while tag := _TAG.search(page, at):
        if tag.start() > at and not stack[-1].hidden:
            parts.append((page[at : tag.start()], links > 0))
        at = tag.end()
        raw = tag[0]
        name = _NAME.match(raw)
        if not name:
            continue
        name = name[1].lower()
        if raw.startswith("</"):
            if name not in INLINE:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break
            continue
        if stack[-1].name == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        if name in RAW:
            # What they hold is no markup: the first end tag ends them.
            flush()
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            if not stack[-1].hidden:
                parts.append((" ", links > 0))
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            if stack[-1].name in INLINE:  # an inline element that a block interrupts is not carried on
                depth = len(stack)
                while stack[depth - 1].name in INLINE:
                    depth -= 1
                close(depth)
            if stack[-1].name == name and name in CLOSED_BY_SAME or stack[-1].name == "p":
                close(len(stack) - 1)
        own = attributes(raw)
        hidden = name in UNSEEN or _hidden(own)
        if hidden and raw.endswith("/>"):
            continue
        over, hint = stack[-1], _hint(name, own)
        links += name == "a"
        stack.append(Element(name, over, over.depth + 1, max(over.good, hint), over.bad + min(0.0, hint), over.hidden or hidden, over.listed or name == "li"))
    if at < len(page) and not stack[-1].hidden:
        parts.append((page[at:], links > 0))
    flush()
    return out


def form(block: Block) -> tuple[float, ...]:
    """What a block looks like, apart from names."""
    size = len(block.text)
    share = block.linked / max(1, size)
    marks = sum(block.text.count(c) for c in ".,;!?")
    heading = block.inside.name in ("h1", "h2", "h3", "h4", "h5", "h6")
    return 1.0, math.log1p(size / 80), share, float(min(4, marks)), float(heading), float(block.inside.listed and share < 0.5)


def content_logit(block: Block, weights: Sequence[float] = PRIOR) -> float:
    """Log-odds that a block is content, from its own features."""
    return max(-12.0, min(5.0, block.hints)) + sum(w * x for w, x in zip(weights, form(block), strict=True))


def fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """The most probable weights given forms x and labels y (1: content), both labels counting alike; Newton's method."""
    prior = np.array(PRIOR)
    if not len(y) or y.min() == y.max():
        return PRIOR
    counts = np.where(y == 1, 0.5 * EVIDENCE / (y == 1).sum(), 0.5 * EVIDENCE / (y == 0).sum())
    w = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((counts * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * ((w - prior) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - y)) + w - prior
        step = np.linalg.solve((x.T * (counts * p * (1 - p))) @ x + np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def learned(pages: DataFrame, n_pages: int = PAGES, n_blocks: int = BLOCKS) -> tuple[float, ...]:
    """Weights of form from at most `n_blocks` sure blocks of at most `n_pages` different pages."""
    names = ["x0", "x1", "x2", "x3", "x4", "x5"]

    def sure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["html"]:
                key = zlib.crc32(page.encode("utf-8", "surrogatepass"))
                rows = [(key, k, *form(b), int(b.hints >= SURE)) for k, b in enumerate(blocks_of(page)) if b.inside.bad == 0 and b.hints >= SURE or b.hints <= SURE_NOT]
                yield pd.DataFrame(rows, columns=["page", "at", *names, "y"])

    some = bounded_sample(pages.select("html").where("html IS NOT NULL"), ["html"], n_pages)
    rows = some.mapInPandas(sure, "page bigint, at int, " + ", ".join(f"{n} double" for n in names) + ", y int")
    blocks = materialized(rows, "blocks")  # counted, chosen and read
    got = bounded_sample(blocks, ["page", "at"], n_blocks).toPandas().sort_values([*names, "y"])
    discard(blocks)
    return fitted(got[names].to_numpy(float).reshape(-1, len(names)), got["y"].to_numpy(int))


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. Edges hold in both directions. Shortest augmenting paths by levels."""
    n = len(source)
    s, t = n, n + 1
    graph: list[list[list]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        graph[a].append([b, there, len(graph[b])])
        graph[b].append([a, back, len(graph[a]) - 1])

    for i in range(n):
        # Flow through a node straight from source to sink changes nothing: only the difference matters.
        less = min(source[i], sink[i])
        if source[i] > less:
            join(s, i, source[i] - less, 0.0)
        elif sink[i] > less:
            join(i, t, sink[i] - less, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for b, room, _ in graph[a]:
                if room > 1e-9 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        while True:
            # One path by depth-first search along the levels, without recursion.
            path: list[tuple[int, int]] = []
            a = s
            while a != t:
                while at[a] < len(graph[a]):
                    b, room, _ = graph[a][at[a]]
                    if room > 1e-9 and level[b] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(graph[a]):
                    path.append((a, at[a]))
                    a = graph[a][at[a]][0]
                elif path:
                    a, k = path.pop()
                    at[a] = k + 1
                else:
                    break
            if a != t:
                break
            flow = min(graph[a][k][1] for a, k in path)
            for a, k in path:
                edge = graph[a][k]
                edge[1] -= flow
                graph[edge[0]][edge[2]][1] += flow


def _apart(a: Element, b: Element) -> int:
    """Steps from two blocks' elements up to their nearest common one."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
        if steps > 40:  # halved so often, an edge has no capacity
            break
    return steps


def labelled(page: str | None, weights: Sequence[float] = PRIOR) -> list[tuple[Block, bool]]:
    """The page's blocks with their label: content or not."""
    blocks = blocks_of(page) if page else []
    source, sink = [], []
    for block in blocks:
        x = content_logit(block, weights)
        # -log of the probability of each label: what the label costs.
        cost = (math.log1p(math.exp(-abs(x))) + max(0.0, -x), math.log1p(math.exp(-abs(x))) + max(0.0, x))
        sink.append(cost[0])
        source.append(cost[1])
    edges = []
    for i, a in enumerate(blocks):
        for j in range(i + 1, min(len(blocks), i + 1 + REACH)):
            b = blocks[j]
            near = NEXT if j == i + 1 else 0.0
            near += SIBLING * PER_STEP ** max(0, _apart(a.inside, b.inside) - 2) / (j - i)
            # A change of hints between two blocks marks a border in the tree, where smoothness is weak.
            capacity = near * math.exp(-abs(a.hints - b.hints) / 2)
            if capacity > 1e-6:
                edges.append((i, j, capacity))
    return list(zip(blocks, minimum_cut(source, sink, edges), strict=True))


def main_text(page: str | None, weights: Sequence[float] = PRIOR) -> str:
    return "\n".join(block.text for block, content in labelled(page, weights) if content)


def extracted(pages: DataFrame, weights: Sequence[float] = PRIOR) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars, n_blocks, n_content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [labelled(page, weights) for page in batch.pop("html")]
            text = ["\n".join(b.text for b, content in row if content) for row in rows]
            yield batch.assign(
                page_id=batch["page_id"].astype("Int64"),
                text=text,
                n_chars=[len(t) for t in text],
                n_blocks=[len(row) for row in rows],
                n_content=[sum(c for _, c in row) for row in rows],
            )

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_content bigint")


def op5_mincut_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, by weights learned from the same table."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return extracted(pages, learned(pages)).select("page_id", "url", "text", "n_chars")
