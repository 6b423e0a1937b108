"""Main text of web pages by boosted trees over DOM nodes.

Pages are parsed to element trees. Every element gets features (subtree text and link density,
tag, depth, attribute tokens, siblings) and a log-odds that it belongs to or contains the main
text. Decoding is hierarchical: the labelling of highest total log-odds is taken among those in
which a kept element has a kept parent, so ancestors and descendants never contradict each
other (a tree recursion: an element is worth max(0, own + what its children are worth)).

Training needs no labels: a bounded sample of the pages supplies texts. Their semantic
elements (article or main against nav, footer, aside and the like) are one source of
labels; the other are pages composed from these texts in many layouts, in which the parts
are known by construction.

Defined results: null, empty and text-free html give an empty string; unclosed and stray tags
are repaired; scripts, styles, comments, forms' controls and the head are never text; html of
any length is read whole; equal pages give equal texts; other columns are not read. With no
pages to learn from, the composed layouts use built-in filler words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, fit_boosted
from .common import read_table

SAMPLE_PAGES = 300
LAYOUTS_PER_PAGE = 4
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head script style noscript template title textarea select option button svg iframe object canvas math audio video map".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr label".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BARRIER = frozenset("html body div article section main aside nav header footer form table td th ul ol dl blockquote figure".split())
_TAGS = (
    "p div article main section nav header footer aside ul ol li table tr td form h1 h2 h3 blockquote pre figure dl body html a span".split()
)
_TAG_PLACE = {tag: i for i, tag in enumerate(_TAGS)}


class Node:
    """An element that can be kept or dropped as a whole; inline markup belongs to its element."""

    __slots__ = ("tag", "tokens", "parent", "children", "depth", "text", "links", "direct", "blocks", "marks", "start", "label", "parts", "size", "alike", "rival")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: "Node | None"):
        self.tag, self.tokens, self.parent, self.children = tag, tokens, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.text = self.links = self.direct = self.blocks = self.marks = self.start = 0
        self.label = self.parts = self.rival = 0
        self.size = self.alike = 1


class Page(HTMLParser):
    """Element tree, and the text runs in page order as (node, block number, string)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", (), None)
        self.nodes, self.runs = [self.root], []
        self.open: list[tuple[str, Node]] = [("#page", self.root)]
        self.hidden = self.linked = self.block = self.seen = 0

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            if tag in _HIDDEN and tag not in _VOID:
                self._push(tag, self.open[-1][1])
                self.hidden += 1
            return
        if tag in _CLOSES_P:
            self._close_until("p", _BARRIER)
        if tag in _SAME:
            for other in _SAME[tag]:
                self._close_until(other, frozenset(("ul", "ol", "dl", "table", "html", "body")))
        if tag not in _INLINE:
            self.block += 1
        if tag == "br":
            self.handle_data("\n")  # white space inside its block
        if tag in _VOID:
            return
        values = dict(attrs)
        names = " ".join(filter(None, (values.get("class"), values.get("id"), values.get("role"))))
        hide = tag in _HIDDEN or "hidden" in values or "display:none" in (values.get("style") or "").replace(" ", "")
        node = self.open[-1][1]
        if not hide and (tag not in _INLINE or (names and tag in ("a", "span"))):
            tokens = tuple(t for t in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower()) if t)
            node = Node(tag, tokens, node)
            node.parent.children.append(node)
            node.start = self.seen
            self.nodes.append(node)
        self._push(tag, node)
        self.hidden += hide
        self.linked += tag == "a"

    def _push(self, tag: str, node: Node) -> None:
        self.open.append((tag, node))

    def _pop(self) -> None:
        tag, _ = self.open.pop()
        if self.hidden:
            self.hidden -= 1
            return
        self.linked = max(0, self.linked - (tag == "a"))
        if tag not in _INLINE:
            self.block += 1

    def _close_until(self, tag: str, barrier: frozenset) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                while len(self.open) > at:
                    self._pop()
                return
            if self.open[at][0] in barrier:
                return

    def handle_endtag(self, tag):
        if self.hidden and self.open[-1][0] != tag and tag in _HIDDEN and tag not in [t for t, _ in self.open[-self.hidden :]]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                if tag in _INLINE and any(t in _BARRIER for t, _ in self.open[at + 1 :]):
                    return
                while len(self.open) > at:
                    self._pop()
                return

    def handle_data(self, data):
        if self.hidden or not data:
            return
        node, size = self.open[-1][1], len(data.strip())
        self.runs.append((node, self.block, data))
        if size:
            node.direct += size
            node.parts += 1
            node.links += size * bool(self.linked)
            node.marks += data.count(".") + data.count(",")
            self.seen += size


def parse(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    page.close()
    return _finish(page)


def _finish(page: Page) -> Page:
    """Sum up subtrees once the whole page is read."""
    for node in reversed(page.nodes):  # children follow their parents
        node.text += node.direct
        node.blocks += node.tag in ("p", "li", "h1", "h2", "h3", "tr", "blockquote", "pre", "dd")
        if node.parent:
            up = node.parent
            up.text += node.text
            up.links += node.links
            up.blocks += node.blocks
            up.marks += node.marks
            up.parts += node.parts
            up.size += node.size
        if len(node.children) > 1:
            same = Counter(c.tag for c in node.children)
            second, first = sorted(c.text for c in node.children)[-2:]
            for child in node.children:
                child.alike, child.rival = same[child.tag], second if child.text == first else first
    return page


def features(page: Page, tokens: dict[str, float]) -> np.ndarray:
    """One row per element; ``tokens`` has the learned log-odds of attribute tokens."""
    return feature_table([page], tokens)


def feature_table(pages: list[Page], tokens: dict[str, float]) -> np.ndarray:
    """Rows of all elements of several pages; linear in the number of elements."""
    rows, parents, base = [], [], 0
    for page in pages:
        place = {id(n): base + i for i, n in enumerate(page.nodes)}
        lowest: list[float] = []
        whole, count = max(page.root.text, 1), len(page.nodes)
        for node in page.nodes:
            parent = node.parent
            up = place[id(parent)] if parent else base
            above = lowest[up - base] if parent else 0.0
            low = high = total = known = 0.0
            if node.tokens:
                odds = [tokens.get(t, 0.0) for t in node.tokens]
                low, high, total, known = min(odds), max(odds), sum(odds), float(any(odds))
            lowest.append(min(above, low))
            parents.append(up)
            rows.append((
                _TAG_PLACE.get(node.tag, -1), node.text, node.direct, node.links, node.blocks, node.marks, node.depth,
                len(node.children), node.size, node.start, len(parent.children) if parent else 1, node.alike, node.rival,
                node.parts, len(node.tokens), total, low, high, above, known, whole, count, parent is None,
            ))
        base += len(page.nodes)
    raw, up = np.array(rows, dtype=np.float64), np.array(parents)
    (tag, text, direct, links, blocks, marks, depth, children, size, start, siblings, alike, rival, parts, n_tokens,
     total, low, high, above, known, whole, count, top) = raw.T
    own, some = np.maximum(text, 1), top == 0
    share = links / own
    measures = np.stack([
        np.log1p(text), np.log1p(direct), share, text / size, blocks, text / np.maximum(blocks, 1), marks / own * 10, depth,
        children, size / count, text / whole, start / whole, siblings, alike / siblings, text / np.where(some, own[up], own),
        np.log1p(rival), parts, direct / own, np.where(some, share[up], 0), n_tokens, top, np.where(some, np.log1p(text[up]), 0),
        total, low, high, above, known,
    ], axis=1)
    kinds = np.zeros((len(raw), 2 * len(_TAGS)))
    here, there = tag >= 0, (tag[up] >= 0) & some
    kinds[np.flatnonzero(here), tag[here].astype(int)] = 1
    kinds[np.flatnonzero(there), len(_TAGS) + tag[up][there].astype(int)] = 1
    return np.concatenate([kinds, measures], axis=1)


def decode(page: Page, odds: np.ndarray) -> set[int]:
    """Kept elements (by id) of the consistent labelling with the highest total log-odds."""
    place = {id(n): i for i, n in enumerate(page.nodes)}
    worth = np.zeros(len(page.nodes))
    for i in range(len(page.nodes) - 1, -1, -1):
        node = page.nodes[i]
        worth[i] = max(0.0, odds[i] + sum(worth[place[id(c)]] for c in node.children))
    kept: set[int] = set()
    for i, node in enumerate(page.nodes):
        if worth[i] > 0 and (node.parent is None or id(node.parent) in kept):
            kept.add(id(node))
    return kept


def assemble(page: Page, kept: set[int]) -> str:
    """Blocks of kept text, white space collapsed, in page order."""
    blocks: list[str] = []
    last, held = None, []
    for node, block, data in page.runs:
        if id(node) not in kept:
            continue
        if block != last and held:
            blocks.append(" ".join("".join(held).split()))
            held = []
        last = block
        held.append(data)
    blocks.append(" ".join("".join(held).split()))
    return "\n".join(b for b in blocks if b)


# --- labels for training -------------------------------------------------------------

_MAIN_TAGS, _OTHER_TAGS = ("article", "main"), ("nav", "header", "footer", "aside", "form", "menu", "dialog")
_NAMED = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar"),
    "header": ("header", "masthead", "banner", "site-header", "branding"),
    "footer": ("footer", "colophon", "site-footer", "copyright", "legal"),
    "side": ("sidebar", "aside", "related", "widget", "recommended", "trending", "popular", "more-links", "author-box", "tags"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsor", "promo", "banner-ad", "sponsored"),
    "notice": ("cookie", "notice", "consent", "alert", "gdpr", "popup", "newsletter", "subscribe", "paywall", "disclaimer"),
    "share": ("share", "social", "toolbar", "pagination", "pager", "login", "search"),
    "comments": ("comments", "comment", "comment-list", "disqus", "responses", "replies", "discussion", "comment-body"),
}
_CONTENT = ("content", "post", "entry", "entry-content", "post-body", "article-body", "story", "main-content", "article", "text", "body-text")
_OTHER_TOKENS = frozenset(t for names in _NAMED.values() for name in names for t in name.split("-")) - {"body", "list", "more", "site"}


def _is_other(node: Node) -> bool:
    return node.tag in _OTHER_TAGS or bool(_OTHER_TOKENS.intersection(node.tokens))


def teach(page: Page) -> bool:
    """Label elements from semantic markup; False when the page has none."""
    mains = [n for n in page.nodes if n.tag in _MAIN_TAGS or "data-main" in n.tokens]
    if not mains:
        return False
    main = max(mains, key=lambda n: n.text)
    for node in page.nodes:
        inside, other, up = False, False, node
        while up is not None:
            other = other or (_is_other(up) and not inside)
            if up is main:
                inside = True
                break
            up = up.parent
        node.label = int(inside and not other)
    up = main
    while up is not None:
        up.label, up = 1, up.parent
    return True


_FILLER = ["Words of a line that says something, at length and in full sentences."] * 8


def compose(rng: np.random.Generator, body: list[str], side: list[str]) -> str:
    """A page in a random layout from known texts; its main element carries ``data-main``."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    some = lambda p: rng.random() < p
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")

    def attr(kind: str) -> str:
        if some(0.1):
            return ""
        return f' {pick(["class", "id", "class", "role"])}="{pick(_NAMED[kind])}{pick(["", "", " wide", " box", "-1"])}"'

    def links(n: int) -> str:
        items = [f'<a href="/{k}">{esc(" ".join(pick(side).split()[: int(rng.integers(1, 6))]))}</a>' for k in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if some(0.7) else " | ".join(items)

    def part(kind: str) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "notice": "div", "comments": "section"}.get(kind, "div")
        tag = tag if some(0.5) else pick(["div", "div", "section", "ul"])
        if kind in ("nav", "share"):
            inner = links(int(rng.integers(3, 9)))
        elif kind == "side":
            inner = f"<h3>{esc(pick(side)[:40])}</h3>" + (links(int(rng.integers(2, 8))) if some(0.7) else f"<p>{esc(pick(side))}</p>")
        elif kind == "comments":
            inner = f"<h2>{int(rng.integers(1, 40))} comments</h2>" + "".join(
                f'<{"li" if some(0.3) else "div"}{attr("comments")}><p>{esc(pick(body + side))}</p></div>' for _ in range(int(rng.integers(1, 6)))
            )
        elif kind == "notice":
            inner = f"<p>{esc(pick(side))}</p>" + ("<button>OK</button>" if some(0.5) else "")
            if some(0.3):
                return f'<form{attr(kind)}><label>{esc(pick(side)[:30])}</label><input name="q">{inner}</form>'
        elif kind == "footer":
            inner = f"&copy; {esc(pick(side))}" + (links(3) if some(0.4) else "")
        else:
            inner = esc(pick(side)) if some(0.5) else f"<p>{esc(pick(side))}</p>"
        named = attr(kind)
        if tag in ("div", "section", "ul") and not named:
            named = f' class="{pick(_NAMED[kind])}"'
        return f"<{tag}{named}>{inner}</{tag}>"

    n = int(rng.integers(1, max(2, min(len(body), 14) + 1)))
    at = int(rng.integers(0, max(1, len(body) - n + 1)))
    inner = ""
    for number, paragraph in enumerate(body[at : at + n]):
        shape = pick(["p", "p", "p", "p", "h2", "blockquote", "li", "div"]) if number else pick(["h1", "h1", "p", "h2"])
        value = f"<b>{esc(paragraph)}<br>" if some(0.1) else esc(paragraph)
        inner += f"<ul><li>{value}</li></ul>" if shape == "li" else f"<{shape}>{value}</{shape}>" if some(0.9) else f"<{shape}>{value}"
        if some(0.08):
            inner += part(pick(["ad", "notice", "share", "side"]))
    container = pick(["article", "main", "div", "div", "div", "section", "td"])
    named = f' {pick(["class", "id"])}="{pick(_CONTENT)}"' if container in ("div", "section", "td") and some(0.85) or some(0.2) else ""
    inner = f"<{container}{named} data-main>{inner}</{container}>"
    inner = f"<table><tr>{inner}</tr></table>" if container == "td" else inner
    before = "".join(part(k) for k in ("notice", "header", "nav", "ad") if some(0.5))
    after = "".join(part(k) for k in ("share", "ad", "side", "comments", "notice") if some(0.4)) + (part("footer") if some(0.8) else "")
    middle = before + inner + after
    for _ in range(int(rng.integers(0, 3))):
        middle = f'<div class="{pick(["page", "wrap", "container", "row", "col", "layout"])}">{middle}</div>'
    return f"<html><head><title>{esc(pick(side))}</title></head><body>{middle}</body></html>"


class _Marked(Page):
    """Keeps the mark of composed main elements as a token, which features do not see."""

    def handle_starttag(self, tag, attrs):
        before = len(self.nodes)
        super().handle_starttag(tag, [a for a in attrs if a[0] != "data-main"])
        if len(self.nodes) > before and any(a[0] == "data-main" for a in attrs):
            self.nodes[-1].tokens += ("data-main",)


def token_odds(pages: list[Page]) -> dict[str, float]:
    """Smoothed log-odds of label 1 for every attribute token of labelled pages."""
    seen: dict[str, list[int]] = {}
    for page in pages:
        for node in page.nodes:
            for token in set(node.tokens):
                seen.setdefault(token, [0, 0])[node.label] += 1
    return {t: float(np.log((one + 0.5) / (zero + 0.5))) for t, (zero, one) in seen.items() if zero + one >= 5}


def _training_pages(pages: list[str]) -> list[Page]:
    """Labelled pages: those with semantic markup, and composed ones."""
    rng = np.random.default_rng(42)
    done, bodies, sides = [], [], list(_FILLER)
    for html in pages:
        page = parse(html)
        if teach(page):
            done.append(page)
            main = {id(n) for n in page.nodes if n.label}
            bodies.append([b for b in assemble(page, main).split("\n") if b])
            sides += [b for b in assemble(page, {id(n) for n in page.nodes} - main).split("\n") if b]
    bodies = [b for b in bodies if b] or [_FILLER]
    # Other parts also quote texts as long as the main one's, so that length alone decides nothing.
    sides += [b for body in bodies for b in body[:: max(1, len(body) // 2)]]
    for body in bodies + [_FILLER] * max(0, 60 - len(bodies)):
        for _ in range(LAYOUTS_PER_PAGE):
            page = _Marked()
            page.feed(compose(rng, body, sides))
            page.close()
            marked = _finish(page)  # ``data-main`` survives as a token only here
            teach(marked)
            for node in marked.nodes:
                node.tokens = tuple(t for t in node.tokens if t != "data-main")
            done.append(marked)
    return done


@dataclass(frozen=True)
class PageModel:
    """Attribute token odds and the trees over all features."""

    tokens: dict[str, float]
    trees: BoostedTrees

    def main_texts(self, htmls: list[str | None]) -> list[str]:
        parsed = [parse(h) for h in htmls]
        odds = self.trees.log_odds(feature_table(parsed, self.tokens))
        cuts = np.cumsum([len(p.nodes) for p in parsed])[:-1]
        return [assemble(p, decode(p, o)) for p, o in zip(parsed, np.split(odds, cuts))]


def train(pages: list[str]) -> PageModel:
    """Fit token odds and trees on a bounded list of pages."""
    labelled = _training_pages(pages)
    tokens = token_odds(labelled)
    x = feature_table(labelled, tokens)
    y = np.concatenate([[n.label for n in p.nodes] for p in labelled]).astype(float)
    return PageModel(tokens, fit_boosted(x, y, trees=60, depth=4))


def train_on(pages: DataFrame, rows: int = SAMPLE_PAGES, key: str = "page_id", html: str = "html") -> PageModel:
    """Train on the ``rows`` pages with the smallest key hashes."""
    known = pages.filter(F.col(html).isNotNull())
    ids = known.select(key).orderBy(F.xxhash64(key), key).limit(rows)
    found = known.join(F.broadcast(ids), key).select(key, html).limit(2 * rows).collect()  # repeated keys stay bounded
    return train([r[1] for r in sorted(found, key=lambda r: (r[0], r[1]))])


def extract(pages: DataFrame, model: PageModel, html: str = "html") -> DataFrame:
    """``pages`` with ``text``: the main text of each row; an input column ``text`` is replaced."""

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for start in range(0, len(batch), 64):
                out += model.main_texts(list(batch.iloc[start : start + 64]))
            yield pd.Series(out, dtype=object)

    return pages.withColumn("text", main_text(F.col(html)))


def op5_html(spark, sf_dir: str) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, train_on(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
