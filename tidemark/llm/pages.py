"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every run of text between block boundaries is a node that is content or not. Node potentials depend on
tag, class words, length and links; edge potentials join parent and child. Sum-product messages go up and down the tree
once, so each node's marginal is exact; runs of text whose marginal reaches one half are the main text. Weights
come from labelled pages by gradient ascent on the likelihood, with the same messages for the expectations.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product
from math import exp, log1p

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.base import quoted, text_of, without

BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary hr center menu "
    "dialog search hgroup legend".split()
)
#: Elements whose content is no text of the page.
HIDDEN = frozenset(
    "script style noscript template title head svg iframe object select textarea button option annotation annotation-xml".split()
)
#: What may stand in a head; any other tag ends it.
IN_HEAD = frozenset("head base link meta noscript script style template title".split())
#: Hidden elements that hold none of their kind: a second one ends the first.
FLAT = frozenset("button option select".split())
RAW = frozenset("script style textarea title noscript iframe".split())
#: What ends each of them.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
VOID = frozenset("br hr img input meta link source wbr area base col embed track param".split())
#: A new element of the first kind ends an open one of the second, up to an element of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Attributes as a browser reads them: a name, and after an equals sign a value in quotes or up to a space. Each character is read once,
#: so a tag that is never closed costs no more than its length.
ATTRIBUTES = (
    r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+"
)
MARKUP = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|data-content)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: The label of an element of a labelled page; other pages may use the attribute for anything.
LABEL = re.compile(r"(?:^|\s)data-content\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"[ \t\n\r\f\v]+")


Edges = list[list[list[float]]]


@dataclass
class Node:
    parent: int
    tag: str
    names: tuple[str, ...] = ()
    text: list[str] = field(default_factory=list)
    linked: int = 0
    label: int | None = None


def parse(page: str, labelled: bool = False) -> list[Node]:
    """The blocks and runs of text of a page in document order; a parent stands before its children.

    Only with ``labelled`` are ``data-content`` attributes read, as labels 0 or 1.
    """
    nodes = [Node(-1, "#page")]
    stack = [0]
    names: list[str] = ["#page"]
    run, links, skip, position = -1, 0, "", 0
    deep, loose = 0, False
    ends: dict[str, list[int]] = {}

    def closed(tag: str, at: int) -> bool:
        """Whether a hidden element that starts before ``at`` has an end tag of its own."""
        for name in (f"</{tag}", f"<{tag}"):
            if name not in ends:
                ends[name] = [m.start() for m in re.finditer(rf"{name}(?=[\s/>])", page, re.I)]
        end = bisect_left(ends[f"</{tag}"], at)
        if end == len(ends[f"</{tag}"]):
            return False
        again = bisect_left(ends[f"<{tag}"], at)
        return tag not in FLAT or again == len(ends[f"<{tag}"]) or ends[f"</{tag}"][end] < ends[f"<{tag}"][again]

    def add_text(raw: str) -> None:
        nonlocal run
        if not raw:
            return
        if run < 0:
            if not raw.strip(" \t\n\r\f\v"):
                return
            nodes.append(Node(stack[-1], "#text"))
            run = len(nodes) - 1
        nodes[run].text.append(raw)
        if links:
            nodes[run].linked += len(raw.strip())

    def pop(tags: set[str], stop: set[str]) -> None:
        for depth in range(len(names) - 1, 0, -1):
            if names[depth] in stop:
                return
            if names[depth] in tags:
                del names[depth:], stack[depth:]
                return

    while m := MARKUP.search(page, position):
        if not skip:
            add_text(page[position : m.start()])
        position = m.end()
        if m.group(2) is None:
            continue
        tag, closing = m.group(2).lower(), bool(m.group(1))
        if tag in RAW and not closing and not (skip and m.group(0).endswith("/>")):
            # Nothing inside is markup; the scan goes on behind the closing tag. Without one the text of the page ends
            # here, unless a hidden element is open anyway.
            end = RAW_END[tag].search(page, position)
            if end or not skip:
                position = end.end() if end else len(page)
                continue
        if skip and tag == skip:
            if closing:
                deep -= 1
                skip = skip if deep > 0 else ""
            elif tag in FLAT:
                loose = not closed(tag, position)
            elif not m.group(0).endswith("/>"):
                deep += 1
            continue
        if skip == "head" and (tag in ("html", "body") if closing else tag not in IN_HEAD):
            skip = ""
        elif loose and skip and tag in BLOCKS and (not closing or tag in names):
            # Never closed: it ends with its parent, or at a block.
            skip = ""
        if skip:
            continue
        if tag in HIDDEN:
            if not closing and not m.group(0).endswith("/>"):
                skip, deep = tag, 1
                loose = tag != "head" and not closed(tag, position)
            continue
        if tag == "br":
            add_text(" ")
        elif tag == "a":
            links = max(0, links - 1) if closing else links + 1
        elif tag in BLOCKS:
            run, links = -1, 0
            if closing:
                if tag in names:
                    pop({tag}, set())
                continue
            pop({"p"}, {"td", "th", "blockquote", "div", "section", "article", "li"})
            if tag in CLOSES:
                pop(*CLOSES[tag])
            if tag == "hr":
                continue
            node = Node(stack[-1], tag)
            if len(m.group(3)) > 3:
                found: list[str] = []
                for name, *values in ATTRIBUTE.findall(m.group(3)):
                    value = next(filter(None, values), "")
                    if name.lower() == "data-content":
                        continue
                    if name.lower() == "hidden":
                        found.append("hidden")
                    else:
                        found += [part.lower() for part in NAME_PART.findall(value)]
                node.names = tuple(dict.fromkeys(found))
                if labelled and (label := LABEL.search(m.group(3))):
                    node.label = int(label[label.lastindex])
            nodes.append(node)
            stack.append(len(nodes) - 1)
            names.append(tag)
    if not skip:
        add_text(page[position:])
    return nodes


def clean(parts: list[str]) -> str:
    """The text of a run: references decoded, white space as single spaces, trimmed."""
    return " ".join(html.unescape("".join(parts)).split())


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the features that hold at each node."""
    out = []
    for node in nodes:
        if node.tag != "#text":
            out.append([f"tag={node.tag}", *(f"name={n}" for n in node.names)])
            continue
        length = sum(map(len, node.text))
        share = node.linked / max(1, length)
        size = "0" if length < 200 else "1"
        out.append(["text", f"size={size}", "links=" + ("0" if share < 0.2 else "1" if share < 0.6 else "2")])
    return out


def _soft(x: float) -> float:
    return x + log1p(exp(-x)) if x > 0 else log1p(exp(x))


def kinds(nodes: list[Node]) -> list[int]:
    """The kind of the edge above each node: to a run of text, to a plain block, to one that may start a part."""
    starts = ("div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "dialog", "menu", "body", "html")
    return [0 if n.tag == "#text" else 2 if n.tag in starts or n.names else 1 for n in nodes]


def messages(
    parents: list[int], bias: list[float], edges: Edges, kind: list[int]
) -> tuple[list[float], list[float], list[float]]:
    """Sum-product on a tree whose parents stand before their children.

    ``bias`` is the log odds of state 1 by a node's own potential, ``edges`` has the log potentials of (parent state, child
    state) for each kind of edge. Returns the log odds of each node's marginal, those of its subtree alone, and the message to its parent; all
    relative to state 0, so a message is one number.
    """
    n = len(parents)
    up, sent = list(bias), [0.0] * n
    for i in range(n - 1, 0, -1):
        (e00, e01), (e10, e11) = edges[kind[i]]
        sent[i] = e10 - e00 + _soft(e11 - e10 + up[i]) - _soft(e01 - e00 + up[i])
        up[parents[i]] += sent[i]
    belief = list(up)
    for i in range(1, n):
        (e00, e01), (e10, e11) = edges[kind[i]]
        rest = belief[parents[i]] - sent[i]
        belief[i] = up[i] + (e01 - e00) + _soft(rest + e11 - e01) - _soft(rest + e10 - e00)
    return belief, up, sent


def pair_marginals(
    parents: list[int], edges: Edges, kind: list[int], belief: list[float], up: list[float], sent: list[float]
) -> list[list[list[float]]]:
    """For each kind of edge the sums of the marginals of (parent state, child state)."""
    total = [[[0.0, 0.0], [0.0, 0.0]] for _ in edges]
    for i in range(1, len(parents)):
        edge = edges[kind[i]]
        rest = belief[parents[i]] - sent[i]
        logs = [[edge[s][t] + s * rest + t * up[i] for t in (0, 1)] for s in (0, 1)]
        top = max(map(max, logs))
        weights = [[exp(x - top) for x in row] for row in logs]
        whole = sum(map(sum, weights))
        for s in (0, 1):
            for t in (0, 1):
                total[kind[i]][s][t] += weights[s][t] / whole
    return total


@dataclass(frozen=True)
class Model:
    weights: tuple[tuple[str, float], ...]
    edges: tuple


def labels(nodes: list[Node]) -> list[int]:
    """States of a labelled page: each node has the nearest label at or above it, 0 where there is none."""
    states = [0] * len(nodes)
    for i, node in enumerate(nodes):
        states[i] = node.label if node.label is not None else states[node.parent] if i else 0
    return states


def train(pages: list[str], rounds: int = 100, rate: float = 0.7, ridge: float = 0.0002) -> Model:
    """Fit the model to pages whose elements carry ``data-content`` 0 or 1 where the state changes."""
    trees = []
    index: dict[str, int] = {}
    for page in pages:
        nodes = parse(page, labelled=True)
        rows = [[index.setdefault(f, len(index)) for f in found] for found in features(nodes)]
        trees.append(([n.parent for n in nodes], kinds(nodes), rows, labels(nodes)))
    w, edge = np.zeros(len(index)), np.zeros((3, 2, 2))
    seen_w, seen_edge = np.zeros(len(index)), np.zeros((3, 2, 2))
    for _ in range(rounds):
        grad_w, grad_edge = -ridge * len(trees) * w, -ridge * len(trees) * edge
        known, joint = w.tolist(), edge.tolist()
        for parents, kind, rows, states in trees:
            belief, up, sent = messages(parents, [sum(known[f] for f in r) for r in rows], joint, kind)
            for r, state, odds in zip(rows, states, belief, strict=True):
                gap = state - 1 / (1 + exp(-min(max(odds, -500.0), 500.0)))
                for f in r:
                    grad_w[f] += gap
            for i in range(1, len(parents)):
                grad_edge[kind[i], states[parents[i]], states[i]] += 1
            grad_edge -= pair_marginals(parents, joint, kind, belief, up, sent)
        # Steps scaled by each weight's own past gradients.
        seen_w += grad_w**2
        seen_edge += grad_edge**2
        w += rate * grad_w / np.sqrt(seen_w + 1e-8)
        edge += rate * grad_edge / np.sqrt(seen_edge + 1e-8)
    return Model(tuple(zip(index, w.tolist(), strict=True)), tuple(tuple(map(tuple, e)) for e in edge.tolist()))


_TEXT = (
    "The council met on Tuesday evening to discuss the new bridge, and after two hours of debate it agreed to ask for a second "
    "opinion before the work begins. Several members said that the costs had grown since the first plan was drawn."
)
_LINE = "It will meet again in May."
_HEAD = "Council asks for a second opinion"
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Culture", "Contact", "Weather"))


# Words of class and id attributes that name parts other than the article.
_PART_NAMES = (
    "ad ads advert advertisement sponsored sponsor promo banner cookie cookies consent notice gdpr alert popup modal overlay "
    "privacy newsletter subscribe signup login search comment comments reply discussion responses disqus related recommended "
    "share social sharing toolbar nav navigation navbar menu breadcrumb breadcrumbs pagination tags footer header masthead logo "
    "copyright legal sidebar widget rail topbar disclaimer paywall feedback rating author-box skip"
)


def labelled_pages() -> list[str]:
    """Labelled pages: every way to hold an article, with every kind of part that isn't one around or within it."""
    bodies = [
        f"<h1>{_HEAD}</h1><p>{_TEXT}</p><p>{_LINE}</p><p>{_TEXT}</p>",
        f"<h1>{_HEAD}</h1><p><b>{_LINE}<br><p>{_TEXT}</p><h2>{_LINE}</h2><ul><li>{_LINE}</li><li>{_TEXT}</li></ul>",
        f"<h2>{_HEAD}</h2><div>{_TEXT}</div><blockquote><p>{_LINE}</p></blockquote><pre>{_LINE}</pre>",
        f"<p>{_LINE}</p>",
        "<h1>Late</h1><p>No.</p><p>Of the two.</p>",
        f"<h1>{_HEAD}</h1><p>{_TEXT} <a href='/x'>{_LINE}</a></p><table><tr><th>{_LINE}</th><td>{_LINE}</td></tr></table>"
        f"<figure><figcaption>{_LINE}</figcaption></figure><ol><li>{_TEXT}</li></ol><dl><dt>{_LINE}</dt><dd>{_TEXT}</dd></dl>",
    ]
    holders = [
        '<article data-content="1">{}</article>',
        '<main><article data-content="1">{}</article></main>',
        '<div id="content" data-content="1">{}</div>',
        '<div class="post" data-content="1"><div class="entry-content article-body">{}</div></div>',
        '<section class="story text" data-content="1">{}</section>',
        '<main data-content="1">{}</main>',
        '<div class="page wrapper container"><div data-content="1">{}</div></div>',
    ]
    # Long articles and long parts around them: what many children say must not outweigh what holds them.
    many = [
        f"<h1>{_HEAD}</h1>" + f"<p>{_LINE}</p>" * 100,
        f"<h1>{_HEAD}</h1>" + f"<p>{_TEXT}</p>" * 80,
        f"<h2>{_HEAD}</h2>" + f"<p>{_TEXT}</p><p>Of.</p><ul><li>{_LINE}</li></ul>" * 40,
    ]
    # Parts that are no content, each around several kinds of inside, so that only the part itself tells.
    insides = [
        f"<p>{_TEXT}</p>",
        f"<h3>{_HEAD}</h3><p>{_LINE}</p>",
        _LINE,
        f"<div><p>{_LINE}</p><p>{_TEXT}</p></div>",
        f"<ul>{_LINKS}</ul>",
        f"<h2>{_HEAD}</h2><ul><li>{_LINE}</li><li>{_TEXT}</li></ul>",
        f'{_LINE} <a href="/more">{_LINE}</a>',
    ]
    parts = [
        "<nav>{}</nav>",
        "<header>{}</header>",
        "<footer>{}</footer>",
        "<aside>{}</aside>",
        "<form>{}</form>",
        "<dialog>{}</dialog>",
        "<menu>{}</menu>",
        *(f'<div class="{w}">{{}}</div>' for w in _PART_NAMES.split()),
        *(f'<section id="{w}">{{}}</section>' for w in _PART_NAMES.split()[::2]),
        *(f'<div class="{w}-content">{{}}</div>' for w in _PART_NAMES.split()[1::4]),
        *(f'<table class="{w}"><tr><td>{{}}</td></tr></table>' for w in _PART_NAMES.split()[::5]),
        *(f'<ul class="{w}"><li>{{}}</li></ul>' for w in _PART_NAMES.split()[3::5]),
        *(f'<p class="{w}">{_LINE}</p>' for w in _PART_NAMES.split()[2::4]),
        f"<footer>&copy; Daily Paper &middot; {_LINE}</footer>",
        f"<div>&copy; {_LINE} <a href='/'>{_LINE}</a></div>",
    ]
    outer = [part.format(insides[(i + k) % len(insides)]) for k in (0, 2, 5) for i, part in enumerate(parts)]
    random.Random(0).shuffle(outer)
    pages = []
    for i, (holder, body) in enumerate(product(holders, bodies * 2)):
        around = [outer[(6 * i + k) % len(outer)] for k in range(6)]
        inside = "".join(
            part.replace(">", ' data-content="0">', 1)
            for part in (outer[(3 * i) % len(outer)], outer[(5 * i + 7) % len(outer)])
        )
        whole = holder.format(inside + body + inside if i % 4 == 0 else body + inside if i % 4 == 1 else body)
        pages.append(f"<html><body>{''.join(around[:3])}{whole}{''.join(around[3:])}</body></html>")
    for i, body in enumerate(many):
        for holder in holders[:6]:
            long = "".join(part.format(f"<p>{_LINE}</p>" * 100) for part in parts[i * 9 : i * 9 + 2])
            pages.append(f"<html><body>{outer[i]}{holder.format(body)}{outer[i + 5]}</body></html>")
            pages.append(f"<html><body>{long}{holder.format(bodies[i])}</body></html>")
    # Words of parts on an article's own paragraphs.
    for word in _PART_NAMES.split()[::3]:
        body = f'<h1>{_HEAD}</h1><p>{_TEXT}</p><p class="{word}-price">{_TEXT}</p><p>{_LINE}</p>'
        pages.append(f'<html><body><article data-content="1">{body}</article></body></html>')
    for i, body in enumerate(bodies):
        inside = outer[7 * i].replace(">", ' data-content="0">', 1)
        pages.append(f'<body data-content="1">{inside}{body}</body>')
        pages.append(f'<body data-content="1">{body}{inside}</body>')
    pages.append(f'<body data-content="1">{bodies[0]}</body>')
    pages.append(f'<html><body data-content="1">{bodies[1]}</body></html>')
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


class Extractor:
    def __init__(self, model: Model):
        self.weights = dict(model.weights)
        self.edges = [[list(row) for row in edge] for edge in model.edges]

    def text(self, page: str) -> str:
        nodes = parse(page)
        bias = [sum(self.weights.get(f, 0.0) for f in found) for found in features(nodes)]
        odds, _, _ = messages([n.parent for n in nodes], bias, self.edges, kinds(nodes))
        runs = (clean(n.text) for n, x in zip(nodes, odds, strict=True) if n.tag == "#text" and x >= 0)
        return "\n\n".join(run for run in runs if run)


@lru_cache(maxsize=2)
def _extractor(model: Model) -> Extractor:
    return Extractor(model)


def text_column(page: Column, model: Model) -> Column:
    @pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        extractor = _extractor(model)
        return pd.Series([extractor.text(p) for p in pages], dtype=object)

    return run(page)


def extract(pages: DataFrame, html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Each run of text between block boundaries is one block: references decoded, white space as single spaces, trimmed;
    blocks are joined by two line ends in page order. A null or empty page, and one without any text, has an empty
    result. Unclosed and cut markup is read as far as it goes. Columns of these names are replaced.
    """
    model = default_model() if model is None else model
    kept = without(pages, *({"text", "n_chars"} - {html_col.lower()})).columns
    plain = [f"column_{i}" for i in range(len(kept))]
    rows = pages.select(*map(quoted, kept)).toDF(*plain)
    html_name = next(p for p, c in zip(plain, kept, strict=True) if c.lower() == html_col.lower())
    out = rows.withColumn("extracted", text_column(text_of(html_name), model))
    stays = [(p, c) for p, c in zip(plain, kept, strict=True) if c.lower() not in ("text", "n_chars")]
    return out.select(
        *[F.col(p).alias(c) for p, c in stays], F.col("extracted").alias("text"), F.length("extracted").cast("long").alias("n_chars")
    )

