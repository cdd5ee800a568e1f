"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks of running text. Each block has its word count, its link density, those
of its neighbours, and what its containers say about themselves. A tree learned from a small
labelled table decides which blocks belong to the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from rillflow.llm.arrow import map_batches

# Element names of HTML, as fixed values.
RAW = "script style noscript template svg math iframe object textarea select title canvas audio video"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ARTICLE = frozenset(["article", "main"])
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that containers of page furniture use for themselves.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " sidebar side menu nav navbar navigation navi breadcrumb breadcrumbs footer foot header"
    " masthead topbar toolbar cookie cookies consent notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended"
    " recommendations widget pagination pager search complementary contentinfo disclaimer"
    " copyright legal gdpr form".split()
)
# Beside these names a header belongs to the article.
OWN = frozenset("article post entry story headline".split())
HEADS = frozenset(["header", "masthead", "side"])
COMMENTS = frozenset("comment comments reply replies disqus discussion respond feedback".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW.split())})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    # A tag that the end of the page cuts off.
    r"|</?[a-zA-Z][^<>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PARTS = re.compile(r"[A-Za-z]+?(?=[^A-Za-z]|$|(?<=[a-z])[A-Z])")

FEATURES = (
    "words", "link_density", "words_before", "density_before", "words_after", "density_after",
    "in_article", "in_furniture", "in_hint", "in_comments", "heading",
)


@dataclass
class Block:
    """A run of text without a block-level tag inside."""

    text: str
    words: int
    linked: int
    in_article: bool
    in_furniture: bool
    in_hint: bool
    in_comments: bool
    heading: bool
    elements: tuple[int, ...] = ()
    names: tuple[int, ...] = ()

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    """An open container and what holds for all inside it."""

    name: str
    article: bool = False
    comments: bool = False
    heading: bool = False
    # The containers around it that say they are furniture, by element and by name.
    elements: tuple[int, ...] = ()
    names: tuple[int, ...] = ()


@dataclass
class _Reader:
    stack: list[_Open] = field(default_factory=lambda: [_Open("")])
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    in_link: bool = False
    blocks: list[Block] = field(default_factory=list)
    containers: int = 0

    def text(self, piece: str) -> None:
        if piece:
            self.parts.append(piece)
            if self.in_link:
                self.links.append(piece)

    def close_block(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                linked = min(len(html.unescape("".join(self.links)).split()), len(words))
                top = self.stack[-1]
                self.blocks.append(Block(
                    " ".join(words), len(words), linked, top.article, bool(top.elements),
                    bool(top.names), top.comments, top.heading, top.elements, top.names,
                ))
        self.parts, self.links = [], []

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.in_link = True
        if name == "br":
            self.text(" ")
        if name in INLINE:
            return
        self.close_block()
        if name in VOID or rest.endswith("/"):
            return
        above = self.stack[-1]
        said = set()
        if name not in ("html", "body"):
            for found in NAMES.findall(rest):
                said |= {p.lower() for p in NAME_PARTS.findall("".join(found))}
        article = name in ARTICLE or "main" in said and name == "div"
        comments = above.comments or bool(said & COMMENTS)
        # What lies around an article says nothing about the article, comments excepted.
        fresh = article and not comments
        hinted = said & HINTS - (HEADS if said & OWN else frozenset())
        self.containers += 1
        mine = (self.containers,)
        self.stack.append(_Open(
            name, above.article or article, comments, name in HEADINGS or above.heading,
            (() if fresh else above.elements) + (mine if name in FURNITURE else ()),
            (() if fresh else above.names) + (mine if hinted else ()),
        ))

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name in INLINE:
            return
        self.close_block()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name == name:
                del self.stack[depth:]
                return
            # A stray end tag of a paragraph does not close what holds the paragraph.
            if self.stack[depth].name in ARTICLE | FURNITURE and name not in (
                ARTICLE | FURNITURE | {"body", "html"}
            ):
                return


# Elements that end when the next of their kind begins.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split() + sorted(HEADINGS))


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    reader, at = _Reader(), 0
    for found in TOKEN.finditer(page):
        reader.text(page[at : found.start()])
        at = found.end()
        name = found[3] or found[6]
        if name is None:
            if found[1]:
                reader.text(" ")
            continue
        name = name.lower()
        if found[2] or found[5]:
            reader.end(name)
        else:
            if name in SELF_CLOSING and reader.stack[-1].name == name:
                reader.end(name)
            elif reader.stack[-1].name == "p" and name not in INLINE:
                reader.end("p")
            reader.start(name, found[4] or found[7] or "")
    reader.text(page[at:])
    reader.close_block()
    return _settled(reader.blocks)


def _settled(found: list[Block]) -> list[Block]:
    """Take back what containers with most of a page's own text say of themselves.

    A page may lie in one form, or in a container named for a sidebar beside it; such names tell
    furniture from text only where they mark the smaller part. Pages with an article have said
    already where their text is.
    """
    if any(b.in_article for b in found):
        return found
    own: dict[int, int] = {}
    for b in found:
        for container in {*b.elements, *b.names}:
            own[container] = own.get(container, 0) + b.words - b.linked
    half = sum(b.words - b.linked for b in found) / 2
    most = {container for container, words in own.items() if words > half}
    for b in found:
        b.in_furniture = not most.issuperset(b.elements)
        b.in_hint = not most.issuperset(b.names)
    return found


def features(found: list[Block]) -> np.ndarray:
    """One row per block, in the order of ``FEATURES``."""
    edge = (0, 0.0)
    sizes = [edge, *((b.words, b.density) for b in found), edge]
    rows = [
        (*sizes[i + 1], *sizes[i], *sizes[i + 2], b.in_article, b.in_furniture, b.in_hint,
         b.in_comments, b.heading)
        for i, b in enumerate(found)
    ]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


@dataclass
class Tree:
    """A decision tree: a split, or a share of main text at a leaf."""

    share: float
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    @staticmethod
    def train(rows: np.ndarray, labels: np.ndarray, depth: int = 10, least: int = 1) -> Tree:
        """Split by the Gini index; ties go to the feature named first."""
        tree = Tree(float(labels.mean()) if len(labels) else 0.0)
        if depth == 0 or len(labels) < 2 * least or tree.share in (0.0, 1.0):
            return tree
        best = tree.share * (1 - tree.share) - 1e-9
        for f in range(rows.shape[1]):
            values = np.unique(rows[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                high = rows[:, f] > limit
                n = int(high.sum())
                if least <= n <= len(labels) - least:
                    p, q = labels[high].mean(), labels[~high].mean()
                    gini = (n * p * (1 - p) + (len(labels) - n) * q * (1 - q)) / len(labels)
                    if gini < best - 1e-12:
                        best, tree.feature, tree.limit = gini, f, float(limit)
        if tree.feature >= 0:
            high = rows[:, tree.feature] > tree.limit
            tree.low = Tree.train(rows[~high], labels[~high], depth - 1, least)
            tree.high = Tree.train(rows[high], labels[high], depth - 1, least)
        return tree

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.share)
        high = rows[:, self.feature] > self.limit
        out = np.empty(len(rows))
        out[high], out[~high] = self.high.scores(rows[high]), self.low.scores(rows[~high])
        return out


_LONG = "The river rose in the night and by the morning the lower fields were under water. " * 2
_MID = "Two bridges were closed and trains ran late until the evening of the next day."
_NAV = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "News", "Sport", "About us"))

# The labelled table: pages, and for each of their blocks whether it is main text.
LABELLED = [
    (f"<body><nav><ul>{_NAV}</ul></nav><div class='ad'>Buy two and get one free today.</div>"
     f"<article><h1>High water</h1><p>{_LONG}</p><p>Nobody was hurt.</p><p>Yes.</p><p>{_MID}</p>"
     f"</article><footer>&copy; Valley Post</footer></body>", "0000 0 1 1 1 1 1 0"),
    (f"<body><header><h1>Valley Post</h1><p>All the news of the valley since 1921</p></header>"
     f"<main><h1>Flood</h1><p>{_MID}</p><p>{_LONG}</p><ul><li>Mill Lane</li><li>Bridge End</li>"
     f"</ul><p>Good night.</p></main><aside><h3>Most read</h3><a href='/1'>A dog returns home</a>"
     f"</aside><footer><p>Imprint and <a href='/t'>terms of use</a></p></footer></body>",
     "0 0 1 1 1 1 1 1 0 0 0"),
    (f"<body><div id='menu'>{_NAV}</div><div id='content'><h2>High water in town</h2><p>{_LONG}</p>"
     f"<p>{_MID}</p><p>{_LONG}</p></div><div class='sidebar'><p>{_MID}</p></div>"
     f"<div class='comments'><p>{_LONG}</p><p>I agree.</p></div></body>", "0000 1 1 1 1 0 0 0"),
    (f"<body><ul>{_NAV}</ul><p>{_LONG}</p><p>{_MID}</p><p>{_LONG} {_LONG}</p><p>{_MID}</p>"
     f"<p><a href='/p'>Older</a> <a href='/n'>Newer</a></p><p>Top</p></body>",
     "0000 1 1 1 1 0 0"),
    (f"<body><article><h1>Repairs</h1><p>{_LONG}</p><div class='advert'>{_MID}</div>"
     f"<p>{_MID}</p><form><p>Sign up for our letter</p><label>Mail</label></form><p>It works.</p>"
     f"<section id='comments'><h2>Comments</h2><p>{_LONG}</p><article><p>{_MID}</p></article>"
     f"</section></article></body>", "1 1 0 1 0 0 1 0 0 0"),
    (f"<body><div class='cookie-notice'>We use cookies to make this page better for you.</div>"
     f"<article><header><a href='/a'>Staff writer</a></header><h1>Old mills of the valley</h1>"
     f"<p>{_MID} See <a href='/m'>the map of all mills along the river</a>.</p><p>{_LONG}</p>"
     f"<p><a href='/s'>Sources</a></p><p>Mills.</p><aside>{_LONG}</aside></article>"
     f"<div class='related'><a href='/r'>More about mills and rivers</a></div></body>",
     "0 0 1 1 1 1 1 0 0"),
    (f"<body><table><tr><td><a href='/1'>One</a></td><td><a href='/2'>Two</a></td></tr></table>"
     f"<div><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div><div>Call us: 555 0100</div>"
     f"<div>All prices in pounds</div></body>", "0 0 1 1 1 0 0"),
    (f"<body><nav><a href='/x'>Start</a><p>{_MID}</p></nav><article><h1>A</h1><p>B.</p><p>C d.</p>"
     f"<blockquote>{_MID}</blockquote><pre>x = 1</pre><p>E.</p></article>"
     f"<div class='share'>Share this story with your friends and family</div></body>",
     "0 0 1 1 1 1 1 1 0"),
    (f"<article><h1><a href='/b'>Bees</a></h1><p><a href='/1'>All about bees in one place</a></p>"
     f"<p>Hm.</p><p><a href='/2'>Hives</a></p><ul><li><a href='/3'>Honey of the valley</a></li>"
     f"<li><a href='/4'>Wax</a></li></ul><p><a href='/5'>{_MID}</a></p><p>Buzz.</p></article>",
     "1 1 1 1 1 1 1 1"),
    (f"<main><p>First of all: thanks.</p><p>{_LONG}</p><p><a href='/e'>The end</a></p></main>",
     "1 1 1"),
    (f"<article><p>One.</p></article>", "1"),
    (f"<article><h1>Two</h1><p><a href='/t'>Three four</a></p></article>", "1 1"),
    (f"<div>Skip to text</div><div>{_NAV}</div><div>Today is Monday</div><div><p>{_LONG}</p>"
     f"<p>{_LONG}</p><p>{_MID}</p></div><div>Made with care</div><div>Print this page</div>",
     "0 0000 0 1 1 1 0 0"),
    (f"<div>Valley Post</div><div>Fair and free</div><p>{_MID}</p><p>{_LONG}</p><p>{_LONG}</p>"
     f"<p>{_MID}</p><div><a href='/up'>To the top of this page</a></div><div>All rights reserved"
     f"</div>", "0 0 1 1 1 1 0 0"),
]


def _said(words: int) -> str:
    """Running text of so many words."""
    return " ".join((_LONG.split() * 12)[:words])


# Pages without an article element: text of many lengths between short and linked blocks.
for _a, _b, _c in (
    (20, 45, 90), (90, 20, 45), (45, 90, 20), (14, 30, 14), (150, 150, 60), (30, 14, 150), (60, 25, 30),
):
    _p, _q, _r = (f"<p>{_said(n)}</p>" for n in (_a, _b, _c))
    LABELLED += [
        (_p, "1"), (f"{_p}{_q}", "1 1"), (f"<div class='post'>{_p}{_q}{_r}</div>", "1 1 1"),
        (f"<h1>High water</h1>{_p}{_q}{_r}", "1 1 1 1"),
        (f"<div class='page with-sidebar'><ul>{_NAV}</ul><h1>Flood</h1>{_p}{_q}{_r}"
         f"<div class='sidebar'><p>{_MID}</p></div></div>", "0000 1 1 1 1 0"),
        (f"<form><ul>{_NAV}</ul><h2>High water in town</h2>{_p}{_q}<p>Nobody was hurt.</p>{_r}"
         f"<p>Sign up</p></form>", "0000 1 1 1 1 1 0"),
        (f"<section id='legal-news'><h1>Court</h1>{_q}{_r}{_p}</section><div>Call us</div>",
         "1 1 1 1 0"),
        (f"<div><a href='/'>Valley Post</a></div><div class='post'>{_r}<p>Yes.</p>{_p}{_q}</div>"
         f"<div><a href='/o'>Older stories from the valley</a></div><div>Imprint</div>",
         "0 1 1 1 1 0 0"),
        (f"<ul>{_NAV}</ul><div class='article-header'><h1>Rain again</h1></div><div>{_p}{_r}</div>",
         "0000 1 1 1"),
    ]
LABELLED += [
    (f"<ul>{_NAV}</ul>", "0000"), ("<div>Home</div><div>Page not found</div>", "0 0"),
    (f"<div>Valley Post</div><ul>{_NAV}</ul><div>All rights reserved</div>", "0 0000 0"),
]
# Furniture with as much text as an article, before, inside and after one.
for _wrap in (
    "<nav>{}</nav>", "<header>{}</header>", "<footer>{}</footer>", "<aside>{}</aside>",
    "<form>{}</form>", "<div class='ad'>{}</div>", "<div class='side-menu'>{}</div>",
    "<div id='sidebar'>{}</div>", "<section class='notice'>{}</section>",
    "<div class='comments'>{}</div>",
):
    _also = _wrap.format(f"<p>{_LONG}</p><p>{_MID}</p>")
    LABELLED += [
        (f"{_also}<div><p>{_LONG}</p><p>{_MID}</p><p>{_LONG}</p></div>{_also}", "00 1 1 1 00"),
        (f"{_also}<article><h1>Rain</h1><p>{_LONG}</p>{_also}<p>It rains.</p><p>{_LONG}</p>{_also}"
         f"</article>{_also}", "00 1 1 00 1 1 00 00"),
    ]


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    rows, labels = [], []
    for page, marks in LABELLED:
        found = blocks(page)
        marked = [m == "1" for m in marks if m != " "]
        if len(found) != len(marked):
            raise ValueError(f"{len(found)} blocks, {len(marked)} labels: {page[:60]}")
        rows.append(features(found))
        labels += marked
    return np.concatenate(rows), np.array(labels, float)


def main_text(page: str | None, tree: Tree) -> tuple[str, int, int]:
    """The article of a page, its blocks in all and how many were kept."""
    found = blocks(page or "")
    if not found:
        return "", 0, 0
    kept = [b.text for b, s in zip(found, tree.scores(features(found))) if s >= 0.5]
    return "\n\n".join(kept), len(found), len(kept)


EXTRACTED = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint"


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html).

    A null or empty html has an empty text; a null page_id or url stays null. Repeated rows stay.
    An empty table gives an empty one.
    """
    tree = tree or Tree.train(*labelled_blocks())

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [main_text(page, tree) for page in batch.column("html").to_pylist()]
        texts = [t for t, _, _ in found]
        yield {
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
            "n_chars": [len(t) for t in texts], "n_blocks": [n for _, n, _ in found],
            "n_kept": [k for _, _, k in found],
        }

    plain = pages.selectExpr("cast(page_id AS bigint) AS page_id", "url", "html")
    return map_batches(plain, work, EXTRACTED)
