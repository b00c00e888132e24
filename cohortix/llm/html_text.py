"""Main-text extraction from web pages: flat text blocks and a decision tree over shallow features.

A page becomes a flat list of text blocks. Each has its word count and link density, those of the
blocks before and after it, and what its open elements say (article, navigation, form, side matter,
advert, comments, heading). A decision tree, grown on the small labelled table ``EXAMPLES``, decides
which blocks are main text.

Defined results: a null or empty page has no text. Repeated rows get a row each. Unclosed tags,
unclosed comments and page ends inside a tag are tolerated: a dropped element without its end tag ends
at the next block's tag, save script and style, which by HTML take the rest. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text of the page, and elements that end a block. A head needs no
#: end tag and holds no text but that of dropped elements, so it is not among them.
_DROPPED = frozenset("script style template noscript svg iframe object canvas textarea select title".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul button".split()
)
#: A dropped element without its end tag ends before these; options belong to a select.
_STOP = re.compile(rf"</?(?:head|{'|'.join(sorted(_BLOCKS - {'option', 'optgroup', 'legend', 'hr'}))})(?=[\s/>])", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SPACE = re.compile(r"\s+")

#: What an element's name or the words of its class, id and role say about its content.
_KINDS = (
    ("menu", frozenset("nav menu menubar navbar navigation breadcrumb breadcrumbs pagination pager toc".split())),
    ("edge", frozenset("header footer banner masthead contentinfo copyright colophon".split())),
    ("side", frozenset("aside sidebar side complementary related recommended recommendations widget widgets share social tags promo trending popular newsletter subscribe".split())),
    ("notice", frozenset("cookie cookies consent notice alert gdpr popup modal dialog banner disclaimer paywall toast".split())),
    ("advert", frozenset("ad ads advert adverts advertisement sponsor sponsored sponsors promoted adsense adsbygoogle".split())),
    ("form", frozenset("form search searchbox login signup button fieldset select label".split())),
    ("comments", frozenset("comment comments disqus discussion replies reply respond commentlist feedback".split())),
)
#: Words of a class, id or itemprop that mark an article's container.
_MARKS = frozenset("article post entry story content main".split())
_WORDS = re.compile(r"[a-z]+")
KINDS = tuple(k for k, _ in _KINDS)
_NAMED = frozenset().union(*(names for _, names in _KINDS), _MARKS) - {"label"}
#: Elements of running text; what they are called follows from what they say.
_RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre td th dd dt tr table".split())
#: Elements that say by themselves what they hold; others may be wrappers round a whole page.
_SAYING = frozenset("nav menu aside header footer dialog button fieldset select label".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    heading: bool
    kinds: frozenset[str]


@dataclass(eq=False)
class _Open:
    """An open element with something to say; ``up`` is the next such element round it, ``first`` the outermost of them
    that marks an article. ``page`` where it holds a main or h1, as a wrapper round a page does.

    What depends on all elements round it is kept with each, so that nesting costs no more than its tags.
    """

    name: str
    kinds: frozenset[str]
    marks: bool
    hidden: bool
    up: _Open | None = None
    page: bool = False
    void: bool = False
    first: _Open | None = None
    depth: int = 0  # elements with kinds round it
    able: bool | None = None  # all of those wrap
    said: frozenset[str] | None = None

    def wraps(self) -> bool:
        return not self.hidden and self.name not in _SAYING and (self.page or "comments" not in self.kinds)


def _settled(e: _Open | None, known, settle) -> None:
    """Apply ``settle`` to an element and those round it, the outermost first, as far as they are not ``known``."""
    chain = []
    while e is not None and not known(e):
        chain.append(e)
        e = e.up
    for x in reversed(chain):
        settle(x)


def _void_wrappers(found: list[tuple[Block, _Open | None]]) -> None:
    """Kinds of wrappers that contain the page's marked article do not count for what they hold.

    The article is the marked container under the fewest elements with kinds, of equals the one of
    most words; containers inside aside, nav and the like and hidden ones do not become it.
    """
    words: dict[_Open, int] = {}
    for b, e in found:
        if e is not None and e.first is not None:
            words[e.first] = words.get(e.first, 0) + b.words

    def able(e: _Open) -> None:
        e.able = e.up is None or (e.up.able and (not e.up.kinds or e.up.wraps()))

    for e in words:
        _settled(e, lambda x: x.able is not None, able)
    candidates = [e for e in words if e.able]
    if candidates:
        w = min(candidates, key=lambda e: (e.depth, -words[e])).up
        while w is not None:
            w.void = True
            w = w.up

    def say(e: _Open) -> None:
        e.said = (e.up.said if e.up else frozenset()) | (frozenset() if e.void else e.kinds)

    for b, e in found:
        _settled(e, lambda x: x.said is not None, say)
        b.kinds = e.said if e is not None else frozenset()


def _end_of(page: str, name: str, at: int, unclosed: dict[str, re.Match | None]) -> int:
    """Where the dropped element ``name`` whose content starts at ``at`` ends."""
    if name not in unclosed:
        m = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
        if m:
            return m.end()
        unclosed[name] = None  # nor is there one further on
    if name in ("script", "style"):
        return len(page)
    m = _STOP.search(page, at)
    return m.start() if m else len(page)


def _kinds_of(name: str, attrs: str) -> tuple[frozenset[str], bool]:
    """What an element says about its content, and whether it is an article's container.

    Elements of running text are named after what they are about (an id of a heading, a class of a figure in the
    text): their ids say nothing, and a class of theirs only where all its words do.
    """
    said = {name}
    about = name in _RUNNING
    if attrs:
        for key, a, b, c in _ATTR.findall(attrs):
            if key.lower() == "id" and (about or (name == "section" and (a or b or c).lower() == "discussion")):
                continue  # a section of that name is a paper's
            for token in (a or b or c).split() if about else (a or b or c,):
                got = _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
                if not about or all(w in _NAMED for w in got):
                    said.update(got)
        if _HIDDEN.search(attrs):
            return frozenset({"notice"}), False
    # the article's own header holds its heading; a page-wide wrapper's class says little
    if name in ("html", "body", "main", "article"):
        return frozenset(), name in ("main", "article")
    kinds = frozenset(k for k, names in _KINDS if said & names)
    if kinds == {"edge"} and name == "div" and said & _MARKS:
        return frozenset(), False  # an article's own header or footer
    return kinds, not kinds and name in ("div", "section", "td") and bool(said & _MARKS)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order. ``br`` is white space, not the end of a block."""
    out: list[Block] = []
    stack: list[_Open] = []
    found: list[tuple[Block, _Open | None]] = []
    names: Counter[str] = Counter()
    opened: _Open | None = None
    unclosed: dict[str, re.Match | None] = {}
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    article = 0
    heading = False

    def push(e: _Open) -> None:
        if stack:
            top = stack[-1]
            e.up = top if top.kinds or top.marks else top.up
        e.first = e.up.first if e.up and e.up.first else e if e.marks else None
        e.depth = e.up.depth + bool(e.up.kinds) if e.up else 0
        stack.append(e)
        names[e.name] += 1

    def pop() -> _Open:
        e = stack.pop()
        names[e.name] -= 1
        return e

    def end() -> None:
        nonlocal heading
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                n = text.count(" ") + 1
                out.append(Block(text, n, min(n, len("".join(linked).split())), article > 0, heading, frozenset()))
                found.append((out[-1], opened))
            parts.clear()
            linked.clear()

    def text(raw: str) -> None:
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if in_link:
                linked.append(raw + " ")

    at = 0
    while m := _TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if name in _DROPPED:
            if not m[1] and not (name == "svg" and m[3].endswith("/")):
                at = _end_of(page, name, at, unclosed)
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            in_link = 0 if m[1] else 1
            continue
        if name not in _BLOCKS and name not in ("span", "label", "ins"):
            continue
        if name in _BLOCKS:
            end()
            in_link = 0
        if m[1]:
            if names[name]:
                while stack:
                    e = pop()
                    article -= e.marks
                    if e.name == name:
                        break
        elif name not in _VOID and not m[3].endswith("/"):
            if name in ("p", "li") and stack and stack[-1].name == name:
                pop()
            if name in ("main", "h1"):
                for e in reversed(stack):
                    if e.page:  # and so are those round it
                        break
                    e.page = True
            # an article's header is part of it
            own, marks = _kinds_of(name, m[3])
            own = own - (frozenset({"edge"}) if article and name == "header" else frozenset())
            if own or name in _BLOCKS:
                push(_Open(name, own, marks, bool(_HIDDEN.search(m[3]))))
                article += marks
        if name in _BLOCKS:
            heading = not m[1] and name in ("h1", "h2", "h3", "h4", "h5", "h6")
            if m[1] and name[0] == "h" and name[1:].isdigit():
                heading = False
        opened = stack[-1] if stack and (stack[-1].kinds or stack[-1].marks) else stack[-1].up if stack else None
    text(page[at:])
    end()
    _void_wrappers(found)
    return out


FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "article", "heading", "outside", *KINDS, "any_kind")


def features(bs: list[Block]) -> np.ndarray:
    """Rows of ``FEATURES``; ``outside`` is text beside a page's marked article."""
    n = len(bs)
    w = np.array([0, *[b.words for b in bs], 0], float)
    d = np.array([0, *[b.linked / b.words for b in bs], 0], float)
    any_ = any(b.article for b in bs)
    own = np.array([[b.article, b.heading, any_ and not b.article, *[k in b.kinds for k in KINDS], bool(b.kinds)] for b in bs], float).reshape(n, 4 + len(KINDS))
    return np.column_stack([w[1:-1], d[1:-1], w[:-2], d[:-2], w[2:], d[2:], own])


# ---- the labelled table and the tree ------------------------------------------------------------

#: Blocks with their neighbours, by hand: words, link density, the same of the block before and of the
#: block after, in an article, heading, page has an article, kinds, and whether it is main text.
EXAMPLES: tuple[tuple[float, float, float, float, float, float, int, int, int, str, int], ...] = (
    # articles: headings, long and one-word paragraphs, with and without links
    (9, 0, 1, 1, 80, 0, 1, 1, 1, "", 1), (80, 0, 9, 0, 60, 0, 1, 0, 1, "", 1), (60, 0.1, 80, 0, 1, 0, 1, 0, 1, "", 1),
    (1, 0, 60, 0.1, 40, 0, 1, 0, 1, "", 1), (2, 0, 1, 0, 9, 0, 1, 0, 1, "", 1), (400, 0, 2, 0, 12, 0, 1, 0, 1, "", 1),
    (3, 0, 12, 0, 3, 0.5, 1, 1, 1, "", 1), (12, 0.3, 8, 0, 200, 0, 1, 0, 1, "", 1), (5, 1, 90, 0, 70, 0, 1, 0, 1, "", 1),
    (25, 0, 7, 0, 8, 0, 1, 0, 1, "", 1), (1, 0, 1, 0, 1, 0, 1, 0, 1, "", 1), (4, 0, 30, 0, 0, 0, 1, 0, 1, "", 1),
    (60, 0, 5, 1, 40, 0, 1, 0, 1, "", 1), (40, 0, 60, 0, 5, 1, 1, 0, 1, "", 1), (30, 0, 4, 1, 3, 1, 1, 0, 1, "", 1), (3, 1, 4, 1, 5, 1, 1, 0, 1, "", 1),
    (6, 0, 3, 1, 2, 1, 1, 0, 1, "", 1), (2, 0, 5, 1, 0, 0, 1, 0, 1, "", 1), (8, 1, 2, 1, 0, 0, 1, 0, 1, "", 1), (9, 0.5, 1, 1, 80, 0, 1, 1, 1, "", 1),
    # pages without a marked article
    (7, 0, 4, 1, 90, 0, 0, 1, 0, "", 1), (90, 0.02, 7, 0, 70, 0, 0, 0, 0, "", 1), (70, 0, 90, 0, 15, 0, 0, 0, 0, "", 1),
    (15, 0, 70, 0, 30, 0.1, 0, 0, 0, "", 1), (30, 0.1, 15, 0, 3, 1, 0, 0, 0, "", 1), (12, 0, 60, 0, 50, 0, 0, 0, 0, "", 1),
    (11, 0.1, 2, 0, 7, 0, 0, 0, 0, "", 1), (7, 0, 11, 0.1, 1, 0, 0, 0, 0, "", 1), (2, 0, 0, 0, 11, 0.1, 0, 1, 0, "", 1), (14, 0, 9, 0, 0, 0, 0, 0, 0, "", 1),
    (9, 0, 14, 0, 20, 0, 0, 0, 0, "", 1), (4, 0, 60, 0, 45, 0, 0, 0, 0, "", 1), (2, 0, 40, 0, 60, 0, 0, 0, 0, "", 1), (6, 0.2, 50, 0, 33, 0, 0, 0, 0, "", 1),
    (3, 1, 2, 1, 3, 1, 0, 0, 0, "", 0), (2, 1, 3, 1, 7, 0, 0, 0, 0, "", 0), (1, 1, 0, 0, 2, 1, 0, 0, 0, "", 0),
    (5, 0.9, 40, 0, 4, 1, 0, 0, 0, "", 0), (12, 0.8, 4, 1, 9, 0.9, 0, 0, 0, "", 0), (4, 0, 3, 1, 2, 1, 0, 0, 0, "", 0),
    (2, 0, 2, 1, 3, 1, 0, 0, 0, "", 0), (3, 0, 5, 1, 4, 1, 0, 1, 0, "", 0), (6, 0, 4, 1, 0, 0, 0, 0, 0, "", 0),
    # what lies beside a marked article
    (11, 0, 1, 1, 9, 0, 0, 0, 1, "", 0), (40, 0, 3, 0, 9, 0, 0, 0, 1, "", 0), (3, 1, 3, 1, 2, 1, 0, 0, 1, "", 0),
    (20, 0, 0, 0, 90, 0, 0, 0, 1, "", 0), (9, 0, 5, 0, 70, 0, 0, 0, 1, "", 0), (70, 0, 9, 0, 70, 0, 0, 0, 1, "", 0), (8, 0, 200, 0, 0, 0, 0, 0, 1, "", 0), (60, 0, 200, 0, 4, 0, 0, 0, 1, "", 0), (5, 0, 0, 0, 11, 0, 0, 1, 1, "", 0),
    # menus, edges, sides, notices, adverts, forms and comments, inside and outside of articles
    (1, 1, 1, 1, 1, 1, 0, 0, 1, "menu", 0), (2, 1, 1, 1, 9, 0, 0, 0, 0, "menu", 0), (3, 0, 50, 0, 2, 1, 1, 0, 1, "menu", 0),
    (14, 0, 60, 0, 0, 0, 0, 0, 1, "edge", 0), (30, 0.1, 80, 0, 9, 0, 0, 0, 0, "edge", 0), (5, 0, 60, 0, 2, 1, 1, 0, 1, "edge", 0),
    (45, 0.1, 60, 0, 30, 0, 0, 0, 0, "side", 0), (30, 0, 45, 0, 60, 0, 1, 0, 1, "side", 0), (4, 0, 30, 0, 45, 0, 0, 1, 0, "side", 0),
    (35, 0.1, 0, 0, 2, 1, 0, 0, 0, "notice", 0), (20, 0, 60, 0, 60, 0, 1, 0, 1, "notice", 0), (50, 0, 70, 0, 70, 0, 0, 0, 0, "notice", 0),
    (12, 0, 1, 1, 9, 0, 0, 0, 0, "advert", 0), (40, 0, 80, 0, 80, 0, 1, 0, 1, "advert", 0), (60, 0.5, 80, 0, 80, 0, 0, 0, 0, "advert", 0),
    (6, 0, 60, 0, 3, 0, 0, 0, 0, "form", 0), (25, 0, 60, 0, 40, 0, 1, 0, 1, "form", 0), (30, 0, 20, 0, 70, 0, 0, 0, 0, "form", 0),
    (50, 0, 60, 0, 40, 0, 0, 0, 0, "comments", 0), (80, 0, 50, 0, 30, 0, 1, 0, 1, "comments", 0), (3, 0, 80, 0, 50, 0, 1, 1, 1, "comments", 0),
    (60, 0, 40, 0, 0, 0, 1, 0, 1, "comments", 0), (90, 0, 90, 0, 90, 0, 0, 0, 0, "comments", 0),
)


def table() -> tuple[np.ndarray, np.ndarray]:
    x = [[*e[:8], float(e[8] and not e[6]), *[float(k in e[9].split()) for k in KINDS], float(bool(e[9]))] for e in EXAMPLES]
    return np.array(x, float), np.array([e[10] for e in EXAMPLES])


@functools.cache
def tree() -> tuple:
    """A decision tree (feature, cut, below, above) or a leaf's share of main text, grown by Gini gain."""
    x, y = table()

    def grow(rows: np.ndarray):
        t = y[rows]
        if t.min() == t.max():
            return float(t[0])
        best = None
        for j in range(x.shape[1]):
            v = np.unique(x[rows, j])
            for c in (v[:-1] + v[1:]) / 2:
                low = x[rows, j] <= c
                if j < 6 and min(low.sum(), (~low).sum()) < 2:
                    continue
                imp = sum(len(s) * s.mean() * (1 - s.mean()) for s in (t[low], t[~low]))
                # of equal gains, the cut on what the open elements say, then the first
                if best is None or imp < best[0] - 1e-9 or (abs(imp - best[0]) <= 1e-9 and j >= 6 > best[1]):
                    best = (imp, j, float(c))
        if best is None:
            return float(t.mean())
        low = x[rows, best[1]] <= best[2]
        return (best[1], best[2], grow(rows[low]), grow(rows[~low]))

    return grow(np.arange(len(y)))


def main_text(bs: list[Block]) -> np.ndarray:
    """Which blocks the tree takes for main text, for all blocks at once."""
    x = features(bs)
    out = np.zeros(len(bs), bool)

    def go(node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, float):
            out[rows] = node >= 0.5
            return
        low = x[rows, node[0]] <= node[1]
        go(node[2], rows[low])
        go(node[3], rows[~low])

    go(tree(), np.arange(len(bs)))
    return out


def text_of(page: str | None) -> str:
    bs = blocks(page or "")
    return "\n\n".join(b.text for b, keep in zip(bs, main_text(bs), strict=True) if keep)


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row."""
    kind, ukind = (dict(pages.dtypes)[c] for c in (page_id, url))

    def go(it):
        for b in it:
            texts = [text_of(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    return rows.mapInArrow(go, f"page_id {kind}, url {ukind}, text string, n_chars long")
