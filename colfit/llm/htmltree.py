"""Main text of HTML pages by a tree-structured graphical model.

The variables are a page's block elements, in a tree as they nest; inline markup belongs
to the block around it.  Each is in one of three states: it holds the article among
other things (container), is part of the article (content), or is not (boilerplate).
Node potentials come from tag, names in class and id, amount of text, share of links and
punctuation; edge potentials from parent and child.  Sum-product messages, upward from
the leaves and back downward, give every block's marginals, and the text of blocks that
are content by more than half is the page's main text.

The potentials are log frequencies counted on labelled pages: the few pages of
``LABELLED`` with a label on every part, and of about ``TRAINING_PAGES`` pages of the
corpus those whose own markup labels them, with one article or main element.  Those are
counted twice, the second time with that element's tag hidden, so that the model can do
without.

Markup is read once, in time linear in the page's length and depth.  An end tag closes the
innermost open element of its name unless a list or table stands between; a tag without
its ``>`` is text; a quote that nothing closes does not hide the ``>`` after it; a comment,
script or style that nothing closes lasts to the end, as in browsers; any other element
without visible text that nothing closes hides nothing.

Results by case: a page that is null, empty or without text gives an empty text; a page of
any length is used whole, by one task; a block that is content by exactly half is left
out; rows that repeat an id are pages of their own; an empty table gives no rows; only
``page_id``, ``url`` and ``html`` are read, whatever other columns are called.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import map_batches

CONTAINER, CONTENT, BOILERPLATE = range(3)
#: Pages of the corpus to look at for labelled ones, by a hash of id and address; never
#: more than twice as many are learned from.
TRAINING_PAGES = 1000
#: Each page of LABELLED counts as this many pages, or as this part of those of the corpus.
SEED_PAGES = 25
SEED_SHARE = 0.25
SMOOTHING = 0.5

# Elements of HTML by what they are.
_UNSEEN = {
    "script", "style", "noscript", "template", "head", "title", "iframe", "svg", "math", "object",
    "canvas", "select", "textarea", "button", "datalist", "audio", "video",
}
_RAW = {"script", "style", "title", "textarea", "iframe", "noscript", "template"}
_BLOCKS = {
    "html": "page", "body": "page", "div": "box", "section": "box", "center": "box", "main": "article",
    "article": "article", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer",
    "aside": "aside", "form": "form", "fieldset": "form", "dialog": "form", "p": "p", "h1": "heading",
    "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "hgroup": "heading",
    "ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "table": "table",
    "thead": "table", "tbody": "table", "tfoot": "table", "tr": "table", "td": "cell", "th": "cell",
    "caption": "cell", "blockquote": "quote", "pre": "quote", "figure": "figure", "figcaption": "figure",
    "address": "address", "details": "box", "summary": "box",
}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
#: An opening tag that ends an open element of its own kind first.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_FENCES = {"ul", "ol", "dl", "table", "html", "body"}

#: Of these a second one ends the first.
_ALONE = {"button", "select"}

_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_STOP = re.compile(r"""[>"']""")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in _RAW}
_NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BAD_NAME = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|sidebar|side|foot\w*|masthead|header|"
    r"breadcrumbs?|comments?|comment\w*|disqus|repl(?:y|ies)|cookies?|consent|notices?|gdpr|alerts?|popup|modal|overlay|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|widget|toolbar|"
    r"pagination|pager|tags?|copyright|legal|contentinfo|complementary|navigation)(?![a-z])"
)
_GOOD_NAME = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|post|entry|story|body|text|page)(?![a-z])")
_SENTENCE = re.compile(r"[.!?,;:]")

LABELLED = (
    """<body y=0><header y=2 class="site-header"><div y=2 class="logo">The Daily Paper</div><ul y=2><li y=2><a href=/>Home</a>
    <li y=2><a href=/n>News</a></ul></header><div y=0 id="wrap"><div y=1 class="post-content"><h1 y=1>A long day on the river</h1>
    <p y=1>The boats left early in the morning, when the fog was still on the water, and nobody spoke for an hour.</p>
    <p y=1>Short one.</p><ul y=1><li y=1>Bread, cheese and a bottle of water.</li><li y=1>A map, which was of no use.</li></ul>
    <h2 y=1>What came after</h2><p y=1>By noon the sun was out, and the mood was better; see <a href=/x>the map</a> for the way.</p>
    <blockquote y=1>It was the best trip of the year, he said.</blockquote></div>
    <div y=2 class="sidebar"><h3 y=2>Most read</h3><ul y=2><li y=2><a href=/1>Ten things to do</a><li y=2><a href=/2>Rain again</a></ul></div>
    </div><div y=2 class="cookie-notice"><p y=2>We use cookies to give you the best experience, and share data with partners.</p></div>
    <footer y=2><p y=2>Copyright 2020, all rights reserved. <a href=/t>Terms</a> <a href=/p>Privacy</a></p></footer>""",
    """<body y=0><nav y=2><a href=/>Home</a> <a href=/a>About</a></nav><main y=0><article y=1><header y=1><h1 y=1>How bread is made</h1></header>
    <p y=1>Flour, water, salt and time are all that is needed, though few people have the last.</p><p y=1>Mix them and wait.</p>
    <aside y=2><p y=2>Read also: <a href=/b>the best knives</a></p></aside><figure y=1><figcaption y=1>A loaf, after an hour.</figcaption></figure>
    <p y=1>Then bake it, in a hot oven, until the crust is dark and sounds hollow when you knock on it.</p>
    <div y=2 class="share"><a href=/s>Share</a> <a href=/m>Mail</a></div></article>
    <section y=2 id="comments"><h2 y=2>3 comments</h2><div y=2 class="comment"><p y=2>I tried it, and it was very good, thank you for the recipe!</p></div>
    <div y=2 class="comment"><p y=2>Mine did not rise. What did I do wrong, does anybody know?</p></div></section>
    <form y=2><p y=2>Leave a reply, your address is not published.</p></form></main><footer y=2>Contact us</footer>""",
    """<body y=0><div y=2 class="ad">Buy now and save half of the price, this week only.</div><div y=2 id="menu"><ul y=2><li y=2><a href=/>One</a>
    <li y=2><a href=/2>Two</a><li y=2><a href=/3>Three</a></ul></div><div y=0><div y=0><h1 y=1>Notes from the north</h1>
    <p y=1>There is little to see in winter, and less to do, but the light is worth the way there.</p>
    <table y=1><tr y=1><td y=1>Days of snow</td><td y=1>120</td></table><p y=1>People are kind, if not many words are said.</p></div>
    <div y=2 class="related"><h3 y=2>Related stories</h3><p y=2><a href=/r>A week in the south, where it is warm and dry all year</a></p></div>
    <div y=2 class="newsletter"><p y=2>Subscribe to our letter and get the news first, every Friday.</p><form y=2><div y=2>Your name</div></form></div>
    </div><div y=2 id="footer"><p y=2>All rights reserved by the publisher.</p></div>""",
    """<body y=0><div y=2 class="top"><ul y=2><li y=2><a href=/>Start</a></li></ul></div><article y=1><header y=1><h1 y=1>Six rules for a small garden</h1>
    <p y=1>By A. Gardener, in spring.</p></header><ol y=1><li y=1>Plant what you like to eat, not what the neighbours plant.</li>
    <li y=1>Water in the evening.</li><li y=1>Leave the worms alone, they work for you.</li></ol><ul y=1><li y=1>Seeds</li><li y=1>A spade, a rake and a can</li></ul>
    <h3 y=1>And the rest</h3><p y=1>All other rules are matters of taste.</p><ul y=2 class="tags"><li y=2><a href=/g>garden</a></li></ul>
    <form y=2><p y=2>Send us your own rules, we print the best of them.</p><div y=2>Name</div></form></article>
    <form y=2 action="/s"><div y=2>Search this site for words.</div></form><aside y=2><h2 y=2>The weather</h2><p y=2>Rain, then sun, then rain again until the evening.</p></aside>
    <footer y=2><div y=2>Made in the garden, 2020.</div></footer>""",
    """<body y=0><h1 y=1>Plain page</h1><p y=1>This page has no frame at all, only text, as in the old days of the web.</p>
    <p y=1>It goes on for a while, and then it ends.</p><hr><p y=1>An addition, made later.</p>""",
)
_LABEL = re.compile(r"\by=(\d)")


class Tag(NamedTuple):
    """One tag of a page; a comment or the like has no name."""

    start: int
    end: int
    name: str
    closing: bool
    attributes: str


def tags(source: str) -> list[Tag]:
    """All tags in page order, without what is inside raw elements."""
    found: list[Tag] = []
    last = {c: source.rfind(c) for c in ">\"'"}
    at = source.find("<")
    while 0 <= at < last[">"]:
        end = 0
        if source.startswith("<!--", at):
            stop = source.find("-->", at + 4)
            end = len(source) if stop < 0 else stop + 3
            found.append(Tag(at, end, "", False, ""))
        elif source[at + 1] in "!?":
            end = source.index(">", at) + 1
            found.append(Tag(at, end, "", False, ""))
        elif match := _TAG_NAME.match(source, at):
            end = _tag_end(source, match.end(), last)
            name, closing = match[1].lower(), source[at + 1] == "/"
            attributes = source[match.end() : end - 1]
            if name in _RAW and not closing and not attributes.endswith("/"):
                stop = _RAW_ENDS[name].search(source, end)
                end = len(source) if not stop else (source.find(">", stop.start()) + 1) or len(source)
                name = ""
            found.append(Tag(at, end, name, closing, attributes))
        at = source.find("<", end or at + 1)
    if at >= 0 and source.startswith("<!--", at):
        found.append(Tag(at, len(source), "", False, ""))  # a comment to the end
    return found


def _tag_end(source: str, at: int, last: dict[str, int]) -> int:
    """Past the ``>`` of a tag, of which there is one; quoted values may have others."""
    begin = at
    while match := _TAG_STOP.search(source, at):
        at = match.end()
        if match[0] == ">":
            return at
        before = match.start() - 1
        while before > begin and source[before].isspace():
            before -= 1
        if source[before] == "=" and match.start() < last[match[0]]:
            at = source.index(match[0], at) + 1
    return source.index(">", begin) + 1  # it was inside quotes


def _hidden(found: list[Tag]) -> list[int]:
    """At each tag: how many closed elements without visible text it is inside of, or ends."""
    depth = [0] * (len(found) + 1)
    open_: dict[str, list[int]] = {}
    for i, tag in enumerate(found):
        if tag.name not in _UNSEEN or tag.name == "head" or tag.attributes.endswith("/"):
            continue
        mine = open_.setdefault(tag.name, [])
        if not tag.closing:
            if tag.name in _ALONE:
                mine.clear()
            mine.append(i)
        elif mine:
            depth[mine.pop()] += 1
            depth[i] -= 1
    return list(itertools.accumulate(depth))


class Page:
    """The block elements of a page and its blocks of text, in page order."""

    def __init__(self, source: str, labelled: bool = False):
        self.parent = [-1]
        self.tag = ["html"]
        self.kind = ["page"]
        self.names = ["none"]
        self.label = [CONTAINER]
        self.chars, self.linked, self.marks = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self._read(source, labelled)
        for i in range(len(self.parent) - 1, 0, -1):  # a child comes after its parent
            for counts in (self.chars, self.linked, self.marks):
                counts[self.parent[i]] += counts[i]

    def _read(self, source: str, labelled: bool) -> None:
        stack = [0]
        depths: dict[str, list[int]] = defaultdict(list)  # of the open elements, by name
        fences: list[int] = []
        held: list[str] = []
        link = False

        def flush() -> None:
            if held:
                text = " ".join("".join(held).split())
                held.clear()
                if text:
                    node = stack[-1]
                    self.blocks.append((node, text))
                    self.chars[node] += len(text)
                    self.marks[node] += len(_SENTENCE.findall(text))

        def keep(text: str) -> None:
            if text:
                text = entities.unescape(text) if "&" in text else text
                held.append(text)
                if link:
                    self.linked[stack[-1]] += len(text)

        def close(names: set[str]) -> None:
            """The innermost open element of these names, and what is open inside it."""
            depth = max((depths[n][-1] for n in names if depths[n]), default=0)
            if not depth or (fences and fences[-1] > depth and not names & _FENCES):
                return
            flush()
            for node in stack[depth:]:
                depths[self.tag[node]].pop()
            while fences and fences[-1] >= depth:
                fences.pop()
            del stack[depth:]

        found = tags(source)
        at = 0
        hidden = 0
        for (start, stop, tag, end, attributes), inside in zip(found, _hidden(found), strict=False):
            if not hidden:
                keep(source[at:start])
            at, hidden = stop, inside
            if hidden or not tag:
                continue
            if tag in _BLOCKS:
                if tag in ("html", "body") and (end or tag == "html" or depths["body"]):
                    continue
                flush()
                link = False
                if end:
                    close({tag})
                    continue
                if depths["p"]:
                    close({"p"})
                if tag in _SIBLINGS:
                    close(_SIBLINGS[tag])
                self.parent.append(stack[-1])
                self.tag.append(tag)
                self.kind.append(_BLOCKS[tag])
                self.names.append(_named(attributes))
                label = _LABEL.search(attributes) if labelled else None
                self.label.append(int(label[1]) if label else -1)
                for counts in (self.chars, self.linked, self.marks):
                    counts.append(0)
                depths[tag].append(len(stack))
                if tag in _FENCES:
                    fences.append(len(stack))
                stack.append(len(self.parent) - 1)
            elif tag == "a":
                link = not end
            elif tag == "hr":
                flush()
            elif tag in _VOID:
                held.append(" ")
        if not hidden:
            keep(source[at:])
        flush()

    def label_by_markup(self) -> bool:
        """Label the nodes from one article or main element, if there is just one."""
        marked = [i for i, tag in enumerate(self.tag) if tag == "article"] or [
            i for i, tag in enumerate(self.tag) if tag == "main"
        ]
        if len(marked) != 1:
            return False
        above, i = set(), self.parent[marked[0]]
        while i >= 0:
            above.add(i)
            i = self.parent[i]
        for i in range(len(self.parent)):
            over = self.label[self.parent[i]] if i else CONTAINER
            if i in above:
                self.label[i] = CONTAINER
            elif i == marked[0]:
                self.label[i] = CONTENT
            elif over != CONTENT or self.names[i] == "bad" or self.kind[i] in ("nav", "aside", "footer", "form"):
                self.label[i] = BOILERPLATE
            else:
                self.label[i] = CONTENT
        return True

    def features(self, hide: bool = False) -> list[tuple[str, ...]]:
        """Of each node; with ``hide`` an article or main element looks like a box."""
        out = []
        for kind, names, chars, linked, marks in zip(
            self.kind, self.names, self.chars, self.linked, self.marks, strict=True
        ):
            size = 0 if not chars else 1 if chars < 25 else 2 if chars < 100 else 3 if chars < 400 else 4
            links = 0 if not linked else 1 if linked < 0.3 * chars else 2 if linked < 0.7 * chars else 3
            pointed = 0 if not marks else 1 if marks * 60 < chars else 2
            shown = "box" if hide and kind == "article" else kind
            # Joined where they depend on each other, so that no fact counts twice.
            out.append((f"tag:{shown}:{links}", f"names:{names}", f"size:{size}:{pointed}"))
        return out


def _named(attributes: str) -> str:
    if "=" not in attributes:
        return "none"
    names = " ".join("".join(found) for found in _NAMES.findall(attributes)).lower()
    if not names:
        return "none"
    if _BAD_NAME.search(names):
        return "bad"
    return "good" if _GOOD_NAME.search(names) else "other"


def count_page(page: Page, weight: int, hide: bool, totals: Counter) -> None:
    totals["pages"] += weight
    for i, features in enumerate(page.features(hide)):
        state = page.label[i]
        totals[f"state|{state}"] += weight
        if i:
            totals[f"edge:{page.label[page.parent[i]]}|{state}"] += weight
        for feature in features:
            totals[f"{feature}|{state}"] += weight


class TreeModel:
    """Potentials from counts of (feature, state) and (parent's state, state)."""

    def __init__(self, totals: dict[str, int]):
        states = np.array([totals.get(f"state|{s}", 0) for s in range(3)], float) + SMOOTHING
        self.edge = np.empty((3, 3))
        for over in range(3):
            row = np.array([totals.get(f"edge:{over}|{s}", 0) for s in range(3)], float) + SMOOTHING
            self.edge[over] = row / row.sum()
        self.edge[BOILERPLATE] = (0.0, 0.0, 1.0)  # nothing inside boilerplate is the article
        self.nodes: dict[str, np.ndarray] = {}
        for key in totals:
            feature = key.rpartition("|")[0]
            if feature and feature not in self.nodes and not feature.startswith(("state", "edge")):
                row = np.array([totals.get(f"{feature}|{s}", 0) for s in range(3)], float)
                self.nodes[feature] = np.log((row + SMOOTHING) / (states + SMOOTHING))
        self.known: dict[tuple[str, ...], np.ndarray] = {}

    def _potential(self, features: tuple[str, ...]) -> tuple[float, ...]:
        """The node potential, its largest value one."""
        if (value := self.known.get(features)) is None:
            total = sum((self.nodes.get(f, 0.0) for f in features), np.zeros(3))
            value = self.known[features] = tuple(np.exp(total - total.max()).tolist())
        return value

    def marginals(self, page: Page) -> list[tuple[float, float, float]]:
        """Of every node and state, by messages up and down the tree."""
        parent, n = page.parent, len(page.parent)
        (e00, e01, e02), (e10, e11, e12), (e20, e21, e22) = self.edge.tolist()
        inside = [self._potential(f) for f in page.features()]
        x, y, z = inside[0]
        inside[0] = (x, y * 1e-3, z * 1e-3)  # the page itself is a container
        upward = [(1.0, 1.0, 1.0)] * n  # to the parent, by the parent's state
        for i in range(n - 1, 0, -1):
            a, b, c = inside[i]
            message = e00 * a + e01 * b + e02 * c, e10 * a + e11 * b + e12 * c, e20 * a + e21 * b + e22 * c
            upward[i] = message
            x, y, z = inside[parent[i]]
            x, y, z = x * message[0], y * message[1], z * message[2]
            top = max(x, y, z, 1e-300)
            inside[parent[i]] = x / top, y / top, z / top
        belief = inside
        for i in range(1, n):
            a, b, c = belief[parent[i]]
            u, v, w = upward[i]
            # What the parent hears from everywhere but this node.
            a, b, c = a / u if u > 1e-300 else 0.0, b / v if v > 1e-300 else 0.0, c / w if w > 1e-300 else 0.0
            top = max(a, b, c, 1e-300)
            a, b, c = a / top, b / top, c / top
            x, y, z = inside[i]
            x *= a * e00 + b * e10 + c * e20
            y *= a * e01 + b * e11 + c * e21
            z *= a * e02 + b * e12 + c * e22
            total = max(x + y + z, 1e-300)
            belief[i] = x / total, y / total, z / total
        return belief

    def extract(self, source: str | None) -> str:
        page = Page(source or "")
        if not page.blocks:
            return ""
        marginals = self.marginals(page)
        return "\n\n".join(text for node, text in page.blocks if marginals[node][CONTENT] > 0.5)


def trained(totals: Counter) -> TreeModel:
    """From the counts of the corpus's pages, to which those of ``LABELLED`` are added."""
    weight = max(SEED_PAGES, int(SEED_SHARE * totals["pages"]))
    for source in LABELLED:
        count_page(Page(source, labelled=True), weight, False, totals)
    return TreeModel(totals)


def learn(pages: DataFrame, most: int = TRAINING_PAGES) -> TreeModel:
    marked = F.col("html").rlike("(?i)<(article|main)[\\s>]")
    # Rows are taken by hash where they are read; the limit is for ids that repeat very often.
    share = min(1.0, most / max(pages.count(), 1))
    taken = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))
    sample = pages.where(taken & marked).select("html").limit(2 * most)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for source in batch.column("html").to_pylist():
                page = Page(source)
                if page.label_by_markup():
                    for hide in (False, True):
                        count_page(page, 1, hide, totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["key", "count"]
        )

    counted = map_batches(sample, count, "key string, count bigint").groupBy("key").agg(F.sum("count").alias("count"))
    totals = Counter({r["key"]: r["count"] for r in counted.collect()})
    return trained(totals)


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id, url, text``."""
    model = learn(pages)
    send = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [send.value.extract(s) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    kinds = dict(pages.dtypes)
    return map_batches(
        pages.select("page_id", "url", "html"), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    )
