"""Main text of web pages: flat text blocks, classified by a decision tree over shallow features."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tidy_batches
from .labelled_pages import LABELLED_PAGES

_words = lambda s: frozenset(s.split())
BLOCK_TAGS = _words(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul")
SPACE_TAGS = _words("br wbr img input")
VOID_TAGS = _words("area base br col embed hr img input link meta param source track wbr")
SKIP_TAGS = _words("script style noscript template svg math iframe object select button textarea title")
HEADINGS = _words("h1 h2 h3 h4 h5 h6")
FRAME_TAGS = _words("nav aside footer form dialog menu")
FRAME_ROLES = _words("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar")
FRAME_WORDS = _words(
    "ad ads adbox advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup "
    "promo promoted promotion recommended related respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "tags teaser toolbar topbar widget")
BODY_TAGS = _words("article main")
BODY_WORDS = _words("article body content entry main post story text")

_raw = "|".join(sorted(SKIP_TAGS & _words("script style noscript template textarea title iframe")))
TOKEN = re.compile(
    r"(?is)<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>?"
    rf"|<(?P<raw>{_raw})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attr>(?>[^>"']*(?:"[^"]*"|'[^']*')?)*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attr2>[^>]*)>?"
    r"|(?P<text>[^<]+|<)")
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

FEATURES = ("frame", "body", "page_has_body", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after")


@dataclass
class Block:
    text: str
    frame: bool
    body: bool
    heading: bool
    words: int
    links: float


def kind_of(tag: str, attributes: str, in_body: bool) -> str:
    """"frame", "form", "named" (a frame by its class or id only), "body" or "" for an element that opens."""
    found, role, hidden = set(), "", False
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "role":
                role = value.lower()
            elif name == "hidden" or name == "aria-hidden":
                hidden = hidden or name == "hidden" or value.lower() == "true"
            else:
                found.update(w.lower() for w in re.split(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", value) if w)
    if hidden or tag in FRAME_TAGS - {"form"} or role in FRAME_ROLES - {"form"} or tag == "header" and not in_body:
        return "frame"
    if tag == "form" or role == "form":
        return "form"
    named_frame, named_body = bool(found & FRAME_WORDS), bool(found & BODY_WORDS)
    if named_frame and not named_body and tag not in ("html", "body", "main", "header"):
        return "named"
    if tag in BODY_TAGS or role == "main" or named_body and not named_frame and tag not in ("html", "body", "p", "span", "a"):
        return "body"
    return ""


@dataclass(eq=False)
class Wrapper:
    """A form, or an element named like a frame: one unless what it holds says otherwise."""

    form: bool
    start: int  # blocks before it
    articles: int  # articles before it
    lifted: int = 0  # open elements inside that say it is none
    end: int = -1


def blocks_of(page: str) -> list[Block]:
    """Flat text blocks of a page in order: runs of text between block-level tags, without empty ones.

    A form is no frame to a body element inside it, nor is an element named like a frame to an
    article or main element inside it, unless an article came before (comments and teasers are
    often articles too). Neither is one to any block if it holds all blocks of the page.
    """
    out: list[Block] = []
    inside: list[list[Wrapper]] = []  # of each block: the wrappers that make it a frame
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, str, Wrapper | None, list[Wrapper]]] = []  # open elements, their kinds, themselves as wrappers, wrappers they lift
    wrappers: list[Wrapper] = []
    frames = bodies = links = heading = skipped = articles = 0

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                n = text.count(" ") + 1
                in_links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                inside.append([w for w in wrappers if not w.lifted])
                out.append(Block(text, frames > 0, bodies > 0, heading > 0, n, min(1.0, in_links / n)))
        parts.clear()
        linked.clear()

    def drop(upto: int) -> None:
        nonlocal frames, bodies, links, heading, skipped
        while len(stack) > upto:
            tag, kind, wrapper, lifts = stack.pop()
            if wrapper:
                wrapper.end = len(out)
                wrappers.remove(wrapper)
            for w in lifts:
                w.lifted -= 1
            frames -= kind == "frame"
            bodies -= kind == "body"
            links -= tag == "a"
            heading -= tag in HEADINGS
            skipped -= tag in SKIP_TAGS

    for m in TOKEN.finditer(page):
        kind = m.lastgroup
        if kind == "text" or kind == "cdata":
            if not skipped:
                parts.append(m[0] if kind == "text" else m["cdata"])
                if links:
                    linked.append(parts[-1])
            continue
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, attributes = tag.lower(), m["attr"] or m["attr2"] or ""
        if tag in BLOCK_TAGS:
            close()
        elif tag in SPACE_TAGS:
            parts.append(" ")
        if m["end"] or m["end2"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if at >= 0:
                drop(at)
            continue
        if tag in VOID_TAGS:
            continue
        if tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option", "a"):  # these end an open one of their kind
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    drop(i)
                    break
                if stack[i][0] in ("ul", "ol", "table", "div", "article", "section", "blockquote") and tag != "a":
                    break
        elif tag in BLOCK_TAGS and stack and any(x[0] == "p" for x in stack[-4:]):  # a block ends an open paragraph
            for i in range(len(stack) - 1, max(-1, len(stack) - 5), -1):
                if stack[i][0] == "p":
                    drop(i)
                    break
        if attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        what = kind_of(tag, attributes, bodies > 0)
        wrapper, lifts = None, []
        if what == "form" or what == "named":
            wrapper = Wrapper(what == "form", len(out), articles)
            wrappers.append(wrapper)
        elif what == "body":
            strong = tag in BODY_TAGS or any(m[1].lower() == "role" for m in ATTRIBUTE.finditer(attributes))  # of roles only main is body
            lifts = [w for w in wrappers if w.form or strong and not w.articles]
            for w in lifts:
                w.lifted += 1
            articles += tag == "article" and not frames and all(w.lifted for w in wrappers)
        stack.append((tag, what, wrapper, lifts))
        frames += what == "frame"
        bodies += what == "body"
        links += tag == "a"
        heading += tag in HEADINGS
        skipped += tag in SKIP_TAGS
    close()
    drop(0)
    for block, around in zip(out, inside, strict=True):
        block.frame = block.frame or any(w.start > 0 or w.end < len(out) for w in around)
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: its own words and share of words in links, those of its neighbours, and where it stands."""
    own = np.array([(b.frame, b.body, 0, b.heading, b.words, b.links) for b in blocks], float).reshape(-1, 6)
    own[:, 2] = own[:, 1].any() if len(own) else 0
    edge = np.zeros((1, 2))
    around = np.vstack([edge, own[:, 4:6], edge])
    return np.hstack([own, around[:-2], around[2:]])


@dataclass
class Tree:
    """A binary decision tree as arrays; a leaf has feature -1."""

    feature: list[int]
    limit: list[float]
    left: list[int]
    right: list[int]
    main: list[bool]

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        f, t, lo, hi, main = (np.array(v) for v in (self.feature, self.limit, self.left, self.right, self.main))
        while (inner := f[node] >= 0).any():
            rows = np.flatnonzero(inner)
            at = node[rows]
            node[rows] = np.where(x[rows, f[at]] <= t[at], lo[at], hi[at])
        return main[node]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> Tree:
    """Tree of least Gini impurity; ties go to the earlier feature."""
    tree = Tree([], [], [], [], [])

    def node(rows: np.ndarray, depth: int) -> int:
        k, share = len(tree.feature), y[rows].mean()
        for column, value in zip((tree.feature, tree.limit, tree.left, tree.right, tree.main), (-1, 0.0, -1, -1, share >= 0.5), strict=True):
            column.append(value)
        best = None
        if depth and 0 < share < 1:
            for f in range(x.shape[1]):
                values = np.unique(x[rows, f])
                for limit in (values[1:] + values[:-1]) / 2:
                    low = x[rows, f] <= limit
                    if least <= low.sum() <= len(rows) - least:
                        a, b = y[rows][low].mean(), y[rows][~low].mean()
                        cost = low.mean() * a * (1 - a) + (1 - low.mean()) * b * (1 - b)
                        if best is None or cost < best[0] - 1e-12:
                            best = (cost, f, limit, low)
        if best and best[0] < share * (1 - share) - 1e-9:
            _, f, limit, low = best
            tree.feature[k], tree.limit[k] = f, float(limit)
            tree.left[k] = node(rows[low], depth - 1)
            tree.right[k] = node(rows[~low], depth - 1)
        return k

    node(np.arange(len(y)), depth)
    return tree


def labelled_table(pages: tuple[str, ...] = LABELLED_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the labelled pages: a block of main text starts with "+", any other with "-"."""
    xs, ys = [], []
    for page in pages:
        blocks = blocks_of(page)
        ys += [b.text[0] == "+" for b in blocks]
        xs.append(features(blocks))
    return np.vstack(xs), np.array(ys, float)


def main_text(page: str | None, tree: Tree) -> str:
    """Blocks that the tree takes for main text, joined by an empty line."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n\n".join([b.text for b, main in zip(blocks, tree.predict(features(blocks)), strict=True) if main])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    The tree is grown from the labelled pages on the driver (a few hundred small rows) and
    sent to the tasks; pages are worked on where they are read, whole.

    Defined cases: null and empty html, and pages without main text, give the empty text;
    null ids and urls stay null; repeated rows give repeated rows; broken or unclosed markup
    is read as far as it goes; an empty table gives no rows; further columns are ignored.
    """
    tree = grow(*labelled_table())
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    kinds = [f.dataType.simpleString() for f in rows.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                b = batch.slice(start, 1000)
                texts = [main_text(h.as_py(), tree) for h in b.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(tidy_batches(run), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
