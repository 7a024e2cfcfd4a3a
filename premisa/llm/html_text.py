"""Main text of HTML pages: gradient-boosted trees over DOM nodes, decoded along the hierarchy.

A page becomes a tree of elements. Each element with text gets features: text and link density of its subtree, tokens of
its class, id and role (its own and those above it), depth, and how it compares with its siblings. Trees boosted on pages
made here, with known main content in many layouts, give each element the log-odds of being main content. Decoding picks the
best set of elements in which nothing below a dropped element is kept: for every element either its whole subtree is
dropped, or it is kept and its children choose; so no ancestor contradicts a descendant.

Defined cases: null, empty and tagless pages: no text, or the text itself; a broken page is read as far as its tags make
sense (a tag whose quotes never close ends at the next >; what is nested deeper than 512 elements is put at that depth); repeated rows are read each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premisa.llm.common import ready, tree_nodes

TRAINING_PAGES = 500
ROUNDS, DEPTH, SEED = 20, 4, 11

# Element and attribute vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
SILENT = RAW | frozenset("head select option button object canvas audio video map".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
    "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "tr", "td", "th"]),
}
SCOPE = frozenset("table td th ul ol dl article section div body aside main nav form".split())
AWAY = re.compile(
    r"(^|[^a-z])(nav|navbar|navigation|menu|header|masthead|topbar|footer|foot|sidebar|side|aside|ad|ads|advert|adverts|advertisement|adsense|"
    r"banner|sponsor|sponsored|cookie|cookies|consent|gdpr|notice|alert|promo|promotion|share|sharing|social|related|recommended|widget|"
    r"subscribe|newsletter|signup|breadcrumb|breadcrumbs|login|search|popup|modal|overlay|toolbar|pagination|pager|tags|byline|"
    r"disclaimer|copyright|outbrain|taboola|contentinfo|complementary|skip)([^a-z]|$)")
REPLIES = re.compile(r"(^|[^a-z])(comment|comments|commentlist|reply|replies|respond|disqus|discussion|feedback|reviews)([^a-z]|$)")
MAIN = re.compile(r"(^|[^a-z])(article|content|post|entry|main|story|body|text|page|hentry|prose)([^a-z]|$)")
TAGS = ("div", "p", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "li", "a", "table", "heading", "inline")

_TAGS = r"<!--.*?(?:-->|$)|<!\[CDATA\[|<[!?][^>]*(?:>|$)|{whole}|<(/?)([a-zA-Z][^\s/>]*+)"
#: A whole tag, else its beginning alone. The second never looks for the end: for pages with a tag that has none.
_TAG = re.compile(_TAGS.format(whole=r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"), re.S)
_BEGIN = re.compile(_TAGS.format(whole="(?!)()()()"), re.S)
_MARK = re.compile(r"[>\"']")
#: Elements below this depth become children of the one at it.
DEEPEST = 512
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACES = re.compile(r"\s+")

FEATURES = tuple(f"tag_{t}" for t in TAGS) + (
    "chars", "words", "links", "density", "elements", "paragraphs", "sentences", "inputs", "depth", "place",
    "away", "replies", "main", "above_away", "above_replies", "above_main", "siblings", "alike", "sibling_links", "share",
)


class Node:
    """An element: tag, lower-cased class, id and role, parent, and children (elements, or texts)."""

    __slots__ = ("tag", "marks", "parent", "children", "links", "chars", "words", "elements", "paragraphs", "stops", "inputs", "depth", "place", "number")

    def __init__(self, tag: str, marks: str, parent: Node | None):
        self.tag, self.marks, self.parent = tag, marks, parent
        self.children: list[Node | str] = []
        self.number = -1


def _tag_end(page: str, at: int, hopeless: set[int]) -> int:
    """Where the tag ends whose name ends at ``at``: behind the first > outside quotes; if quotes leave none, behind the
    next >. ``hopeless`` remembers the quotes from which no end was found, so that a page is walked only a few times."""
    here, trail = at, []
    while True:
        m = _MARK.search(page, here)
        if m is not None and m[0] == ">":
            return m.end()
        close = -1 if m is None or m.start() in hopeless else page.find(m[0], m.end())
        if m is not None:
            trail.append(m.start())
        if close < 0:
            hopeless.update(trail)
            return page.find(">", at) + 1 or len(page)
        here = close + 1


def parsed(page: str) -> Node:
    """The tree of a page, in time that grows with its length. Raw elements and what can hold no text are left out."""
    root = Node("html", "", None)
    root.depth = 0
    at, here, end = 0, root, len(page)
    scan, hopeless, last_section = _TAG, set(), page.rfind("]]>")
    while at < end:
        m = scan.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        closing, tag, rest = m[1], m[2], m[3]
        if not tag:
            closing, tag = m[4], m[5]
            if not tag:
                if m[0] == "<![CDATA[":
                    at = page.find("]]>", at) + 3 if at <= last_section else page.find(">", at) + 1 or end
                continue
            scan = _BEGIN
            stop = _tag_end(page, at, hopeless)
            rest, at = page[at:stop].removesuffix(">"), stop
        tag = tag.lower()
        if closing:
            up = here
            while up is not None and up.tag != tag:
                up = None if up.tag in SCOPE and tag not in BLOCK else up.parent
            if up is not None and up.parent is not None:
                here = up.parent
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in ("html", "body"):
            continue
        shut = CLOSES.get(tag)
        up = here
        while up is not None and up.parent is not None and (shut or tag in BLOCK):
            if shut and up.tag in shut or up.tag == "p" and tag in BLOCK:
                here = up.parent
            if up.tag in SCOPE and not (shut and up.tag in shut):
                break
            up = up.parent
        node = Node(tag, " ".join(x for k in _MARKS.findall(rest) for x in k[1:] if x).lower() if rest else "", here)
        node.depth = here.depth + 1
        here.children.append(node)
        if node.depth >= DEEPEST:
            continue
        if tag not in VOID and not rest.rstrip().endswith("/"):
            here = node
        elif tag not in VOID:
            here = node if tag in BLOCK else here
    return root


def _measured(root: Node) -> list[Node]:
    """Elements with text in page order, parents before children, each with the sums of its subtree."""
    out: list[Node] = []
    order: list[Node] = []
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        node.depth, node.number = depth, -1
        order.append(node)
        for c in reversed(node.children):
            if isinstance(c, Node) and c.tag not in SILENT:
                stack.append((c, depth + 1))
    for node in order:
        node.chars = node.words = node.links = node.stops = node.inputs = 0
        node.elements, node.paragraphs = 1, int(node.tag == "p")
    for node in reversed(order):
        for c in node.children:
            if isinstance(c, str):
                bare = c.strip()
                if bare:
                    node.chars += len(bare)
                    node.words += bare.count(" ") + 1
                    node.stops += bare.count(".") + bare.count("!") + bare.count("?")
            elif c.tag in SILENT:
                node.inputs += c.tag in ("select", "button")
            else:
                node.chars += c.chars
                node.words += c.words
                node.links += c.links
                node.stops += c.stops
                node.inputs += c.inputs + (c.tag == "input")
                node.elements += c.elements
                node.paragraphs += c.paragraphs
        if node.tag == "a":
            node.links = node.chars
    seen = 0
    for node in order:
        node.place = seen
        seen += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.chars:
            node.number = len(out)
            out.append(node)
    return out


def features(nodes: list[Node]) -> np.ndarray:
    rows = np.zeros((len(nodes), len(FEATURES)))
    total = max(1, nodes[0].chars) if nodes else 1
    n = len(TAGS)
    family: dict[Node | None, tuple[int, Counter, int, int]] = {}  # of the children of a node
    for i, x in enumerate(nodes):
        tag = "heading" if len(x.tag) == 2 and x.tag[0] == "h" and x.tag[1].isdigit() else x.tag
        rows[i, TAGS.index(tag) if tag in TAGS else TAGS.index("div" if tag in BLOCK else "inline")] = 1
        parent = x.parent
        if parent not in family:
            kin = [c for c in parent.children if isinstance(c, Node) and c.number >= 0] if parent else [x]
            family[parent] = (len(kin), Counter(c.tag for c in kin), sum(c.links for c in kin), max(1, sum(c.chars for c in kin)))
        kin, tags, links, group = family[parent]
        over = rows[parent.number] if parent is not None and parent.number >= 0 else None
        own = [bool(x.marks) and p.search(x.marks) is not None for p in (AWAY, REPLIES, MAIN)]
        rows[i, n:] = (
            np.log1p(x.chars), np.log1p(x.words), x.links / x.chars, x.chars / x.elements, np.log1p(x.elements), np.log1p(x.paragraphs),
            x.stops / x.words, min(x.inputs, 5), x.depth, x.place / total, *own, 0, 0, 0, np.log1p(kin),
            tags[x.tag] / kin, links / group, x.chars / group,
        )
        if over is not None:
            k = n + 13
            rows[i, k] = over[k] or over[n + 10] or over[TAGS.index("nav")] or over[TAGS.index("footer")] or over[TAGS.index("header")] or over[TAGS.index("aside")] or over[TAGS.index("form")]
            rows[i, k + 1] = over[k + 1] or over[n + 11]
            rows[i, k + 2] = over[k + 2] or over[n + 12] or over[TAGS.index("article")] or over[TAGS.index("main")]
    return rows


class Forest:
    """Boosted trees as arrays: the log-odds of each row."""

    def __init__(self, trees: list[list[tuple[int, float, int, int, float]]], weights: list[float]):
        self.trees = [tuple(np.array(c) for c in zip(*t, strict=True)) for t in trees]
        self.weights = weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        every = np.arange(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights, strict=True):
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                down = np.where(rows[every, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
                at = np.where(inner, down, at)
            out += weight * value[at]
        return 2 * out


def decoded(nodes: list[Node], scores: np.ndarray) -> set[int]:
    """Numbers of the kept elements: the best choice without a kept element below a dropped one.

    An element weighs by the text it holds itself; ``drop`` is the value of dropping its whole subtree.
    """
    n = len(nodes)
    keep, drop = np.zeros(n), np.zeros(n)
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        below = [c.number for c in x.children if isinstance(c, Node) and c.number >= 0]
        own = x.chars - sum(nodes[c].chars for c in below)
        value = float(np.clip(scores[i], -4, 4)) * (1 + np.log1p(max(0, own)))
        keep[i] += value + sum(max(keep[c], drop[c]) for c in below)
        drop[i] += -value + sum(drop[c] for c in below)
    kept: set[int] = set()
    for i, x in enumerate(nodes):
        above = x.parent is None or x.parent.number in kept
        if above and (x.parent is None or keep[i] > drop[i]):
            kept.add(i)
    return kept


def blocks(root: Node, kept: set[int]) -> list[str]:
    """The texts of the kept elements, one for each block, white space turned into single spaces."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACES.sub(" ", html.unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif x.tag in VOID:
            if x.tag == "hr":
                close()
        elif x.number in kept:
            if x.tag in BLOCK:
                close()
                stack.append(None)
            stack.extend(reversed(x.children))
        elif x.tag in BLOCK:
            close()
    close()
    return out


def main_text(page: str | None, forest: Forest) -> str:
    if not page:
        return ""
    root = parsed(page)
    nodes = _measured(root)
    return "\n\n".join(blocks(root, decoded(nodes, forest.score(features(nodes))))) if nodes else ""


# Pages with known main content, to train on.

_SYLLABLES = "ka lo mi ther on ti an re sch ung ver que ment ou ción ado la es in ed ar".split()


def _sentence(rng: random.Random, low: int = 4, high: int = 24) -> str:
    made = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    return " ".join(made).capitalize() + rng.choice(".....!?")


def _prose(rng: random.Random, most: int = 6) -> str:
    return " ".join(_sentence(rng) for _ in range(rng.randint(1, most)))


def _links(rng: random.Random) -> str:
    return "".join(f'<li><a href="/{k}">{_sentence(rng, 1, 3)[:-1]}</a></li>' for k in range(rng.randint(2, 9)))


def _aside(rng: random.Random) -> tuple[str, str]:
    """A part that is not main content: (kind, html)."""
    kind = rng.choice("menu header footer sidebar notice advert form comments share related".split())
    text = rng.choice((_sentence(rng), _prose(rng, 4), f"<p>{_prose(rng)}</p>"))
    mark = lambda *names: rng.choice((f'class="{rng.choice(names)}"', f'id="{rng.choice(names)}"', f'class="x {rng.choice(names)} box"'))
    if kind == "menu":
        inner = f"<ul>{_links(rng)}</ul>"
        return kind, rng.choice((f"<nav>{inner}</nav>", f"<div {mark('menu', 'nav', 'navbar', 'main-menu', 'navigation', 'breadcrumbs')}>{inner}</div>", f"<ul {mark('menu', 'nav')}>{_links(rng)}</ul>"))
    if kind == "header":
        inner = rng.choice((f"<h1>{_sentence(rng, 1, 4)[:-1]}</h1>", f"<p>{_sentence(rng)}</p>", f'<a href="/">{_sentence(rng, 1, 3)}</a>' + f"<ul>{_links(rng)}</ul>"))
        return kind, rng.choice((f"<header>{inner}</header>", f"<div {mark('header', 'site-header', 'masthead', 'topbar')}>{inner}</div>"))
    if kind == "footer":
        return kind, rng.choice((f"<footer>&copy; {text}</footer>", f"<div {mark('footer', 'site-footer', 'copyright')}>{text}</div>"))
    if kind == "sidebar":
        inner = rng.choice((text, f"<h3>{_sentence(rng, 1, 4)}</h3><ul>{_links(rng)}</ul>", f"<p>{_prose(rng)}</p><p>{_prose(rng)}</p>"))
        return kind, rng.choice((f"<aside>{inner}</aside>", f"<div {mark('sidebar', 'side', 'widget', 'right-sidebar')}>{inner}</div>"))
    if kind == "notice":
        return kind, rng.choice((f"<div {mark('cookie-notice', 'notice', 'cookies', 'consent', 'alert', 'cookie-banner')}>{text}<button>OK</button></div>", f"<p {mark('notice', 'alert', 'disclaimer')}>{_sentence(rng)}</p>", f'<div role="alert">{text}</div>'))
    if kind == "advert":
        return kind, rng.choice((f"<div {mark('ad', 'ads', 'advert', 'banner', 'sponsored', 'promo', 'ad-box')}>{text}</div>", f"<section {mark('ad', 'promo', 'advertisement')}>{text}</section>", f"<aside {mark('ad', 'sponsor')}>{text}</aside>"))
    if kind == "form":
        return kind, rng.choice((f"<form action='/s'><label>{_sentence(rng, 1, 5)}</label><input name=q><button>Go</button></form>", f"<div {mark('newsletter', 'subscribe', 'login', 'search')}><p>{_sentence(rng)}</p><form><input type=email><input type=submit></form></div>"))
    if kind == "comments":
        each = "".join(rng.choice((f"<div class='comment'><b>{_sentence(rng, 1, 2)}</b><p>{_prose(rng)}</p></div>", f"<li>{_prose(rng)}</li>", f"<p>{_prose(rng)}</p>")) for _ in range(rng.randint(1, 6)))
        return kind, rng.choice((f"<section {mark('comments', 'comment-list', 'discussion')}><h3>{_sentence(rng, 1, 3)}</h3>{each}</section>", f"<div {mark('comments', 'replies', 'respond', 'reviews')}>{each}</div>", f"<ol {mark('commentlist', 'comments')}>{each}</ol>"))
    if kind == "share":
        return kind, f"<div {mark('share', 'social', 'sharing', 'tags')}>{''.join(f'<a href=#>{_sentence(rng, 1, 2)}</a> ' for _ in range(rng.randint(2, 6)))}</div>"
    return kind, rng.choice((f"<div {mark('related', 'recommended', 'related-posts')}><h3>{_sentence(rng, 1, 4)}</h3><ul>{_links(rng)}</ul></div>", f"<section {mark('related')}>{text}</section>"))


def training_page(rng: random.Random) -> str:
    """A page whose main container bears the attribute data-main and whose other parts bear data-away."""
    def away() -> str:
        _, made = _aside(rng)
        return re.sub(r"^<(\w+)", r"<\1 data-away", made)

    body = []
    if rng.random() < 0.8:
        title = f"<h{(k := rng.randint(1, 2))}>{_sentence(rng, 2, 10)[:-1]}</h{k}>"
        body.append(f"<header>{title}</header>" if rng.random() < 0.25 else title)
    for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14))):
        r = rng.random()
        if r < 0.75:
            body.append(f"<p>{rng.choice(('', '<b>', '<i>'))}{_prose(rng)}{rng.choice(('</p>', '<br>', '</p>', '</p>'))}")
        elif r < 0.8:
            body.append(f"<h3>{_sentence(rng, 2, 8)}</h3>")
        elif r < 0.86:
            body.append("<ul>" + "".join(f"<li>{_sentence(rng)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif r < 0.9:
            body.append(f"<blockquote>{_prose(rng)}</blockquote>")
        elif r < 0.93:
            body.append(f"<p>{_sentence(rng)} <a href='/x'>{_sentence(rng, 1, 5)}</a> {_sentence(rng)}</p>")
        elif r < 0.96:
            body.append("<table>" + "".join(f"<tr><td>{_sentence(rng, 1, 3)}<td>{_sentence(rng, 1, 3)}" for _ in range(3)) + "</table>")
        else:
            body.append(f"<div>{_prose(rng)}</div>")
        if rng.random() < 0.06:
            body.append(away())
    if rng.random() < 0.15:
        body.append(away())
    tag, marks = rng.choice((("article", ""), ("article", ""), ("main", ""), ("article", "class='post hentry'"), ("div", "class='content'"), ("div", "id='main'"),
                             ("div", "class='post-body'"), ("section", "class='article'"), ("div", "class='story text'"), ("div", ""), ("section", "")))
    main = f"<{tag} data-main {marks}>{''.join(body)}</{tag}>"
    if rng.random() < 0.3:
        main = f"<div {rng.choice(('class=wrapper', 'id=page', '', 'class=container'))}>{away() * (rng.random() < 0.4)}{main}{away() * (rng.random() < 0.4)}</div>"
    before = "".join(away() for _ in range(rng.randint(0, 4)))
    after = "".join(away() for _ in range(rng.randint(0, 4)))
    return f"<!DOCTYPE html><html><head><title>{_sentence(rng, 2, 6)}</title><script>var x='</p>';</script></head><body>{before}{main}{after}</body></html>"


def _labels(nodes: list[Node], own: dict[Node, str]) -> list[float]:
    """1 for main content and what wraps it, 0 for the rest."""
    out = []
    for x in nodes:
        up, label = x, None
        while up is not None and label is None:
            label = {"main": 1.0, "away": 0.0}.get(own.get(up, ""))
            up = up.parent
        out.append(1.0 if label is None and x.elements > 2 else label or 0.0)
    return out


def training_rows(pages: int = TRAINING_PAGES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        root = parsed(_marked(training_page(rng)))
        own: dict[Node, str] = {}
        nodes = _measured(root)
        for x in nodes:
            for kind in ("main", "away"):
                if f"\x00{kind}" in x.marks:
                    own[x] = kind
                    x.marks = x.marks.replace(f"\x00{kind}", "").strip()
        rows.append(features(nodes))
        labels += _labels(nodes, own)
    return np.concatenate(rows), np.array(labels)


def _marked(page: str) -> str:
    """The training marks as a role, which the parser keeps; a role never holds a NUL otherwise."""
    return re.sub(r" data-(main|away)", lambda m: f' role="\x00{m[1]}"', page)


@functools.lru_cache(maxsize=2)
def _forest_of(application: str, pages: int) -> Forest:
    spark = SparkSession.getActiveSession()
    rows, labels = training_rows(pages)
    frame = pd.DataFrame(rows, columns=list(FEATURES)).assign(label=labels)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(spark.createDataFrame(frame).coalesce(1))
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=SEED).fit(data.select("label", "features"))
    return Forest([tree_nodes(t) for t in model.trees], list(model.treeWeights))


def forest(spark: SparkSession, pages: int = TRAINING_PAGES) -> Forest:
    """The boosted trees, trained once for each application."""
    return _forest_of(spark.sparkContext.applicationId, pages)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ready(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(forest(pages.sparkSession))

    def texts(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        for column in columns:
            yield column.map(lambda x: main_text(x, model), na_action="ignore").fillna("")

    read = F.pandas_udf(texts, "string")
    rows = pages.select("page_id", "url", read(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
