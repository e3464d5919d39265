"""Main text of web pages (operator 4).

Method: maximum-scoring subsequence.  A page is a sequence of words and tags.  Words
score by where they stand (block element, inside a link or not, inside a zone of
menus, notices, forms and the like), tags score negative; the weights are log odds of
lying in the content, from labelled pages: a bounded sample of pages whose markup names
the content (one ``article`` or ``main`` element).  One linear scan finds the
contiguous region of the highest total.  The region is then completed to the smallest
element that holds it, unless that is the whole body, and its blocks are
written out without the zones that are not main text.

Zones.  Elements and roles that name what is not main text, and hidden elements, are left out.
Class and id words and forms only mark a zone, as layout wrappers bear them too: its words
weigh less, and it is left out of the text unless it holds the region.  A marked zone with more
than half of the page's words outside links counts as not marked, and where no text would be
left, none is.

Text rules.  Character references are decoded; white space inside a block becomes one
space; blocks are trimmed, empty ones left out, the rest joined by one newline in page
order.  Nothing is cut or capped.  Broken markup is read as browsers do in
the main: unclosed elements end with their parent, a new block ends an open paragraph,
a cut-off tag at the end is dropped.

Defined results: null html, or a page without content, gives an empty text; null urls are
kept; repeated rows give repeated rows; other columns pass through, ``text`` and ``n_chars``
are replaced; without a labelled page in the sample the weights are ``DEFAULT_WEIGHTS``.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.text import text_column

SAMPLE_PAGES = 2000

#: HTML element names by role (fixed values)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "canvas", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
         "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
         "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE_TAGS = {"aside", "button", "dialog", "footer", "head", "menu", "nav", "audio", "video"}
ASIDE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "menu", "menubar", "navigation",
               "search", "toolbar"}
#: what marks a zone that is probably not main text: elements and roles, words of class and id attributes (fixed values)
MARKED = {"form"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
               "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "topbar",
               "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe",
               "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
               "comments", "commentlist", "disqus", "replies", "respond", "widget", "widgets", "pagination", "pager", "toolbar",
               "copyright", "disclaimer", "skip"}
CONTENT_TAGS = {"article", "main"}
CONTAINERS = CONTENT_TAGS | {"div", "section", "body", "html"}
ENDS_PARAGRAPH = BLOCK - {"html", "body"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSE_LIMIT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

DEFAULT_WEIGHTS = {"word p": 1.0, "word heading": 0.5, "word li": 0.2, "word other": 0.3, "word link": -1.0, "word marked": -1.0, "word aside": -2.0}
DEFAULT_TAG = -0.3
TAG_AT_MOST = -0.05
LIMIT = 3.0

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
                    r"|</?[a-zA-Z][^<>]*(?:>|\Z)|[^<]+|<", re.S)
#: one attribute after the other: name, optional value (never searched for names)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_WORDS = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "parent", "aside", "link", "depth", "header", "zone", "words", "wide")

    def __init__(self, tag, parent, aside, link, header, marked=False):
        self.tag, self.parent, self.aside, self.link, self.header = tag, parent, aside, link, header
        self.depth = parent.depth + 1 if parent else 0
        self.zone = self if marked else parent.zone if parent else None  # the nearest marked element
        self.words, self.wide = 0, False


def _is_aside(tag: str, attrs: str, inside_content: bool) -> tuple[bool, bool]:
    """Whether an element is no main text, and whether it is marked as probably none."""
    if tag in ASIDE_TAGS:
        return True, False
    marked = tag in MARKED
    for m in _ATTRIBUTE.finditer(attrs or ""):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True, False
        if name == "role":
            if value in ASIDE_ROLES:
                return True, False
            marked = marked or value in MARKED
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = set(_WORDS.findall(value))
            marked = marked or bool(words & ASIDE_WORDS) or ("header" in words and not inside_content and tag not in HEADINGS)
    return False, marked


def _zones(e: Element) -> Iterator[Element]:
    """The marked elements around a place, those that hold more than half of the page left out."""
    z = e.zone
    while z is not None:
        if not z.wide:
            yield z
        z = z.parent.zone if z.parent is not None else None


def _weigh_zones(tokens: list[tuple[str, Element, str]]) -> None:
    """Marked elements with more than half of the page's words outside links are wrappers."""
    total, zones = 0, {}
    for kind, e, text in tokens:
        if kind == "text" and not e.aside and not e.link:
            n = len(text.split())
            total += n
            for z in _zones(e):
                zones[id(z)] = z
                z.words += n
    for z in zones.values():
        z.wide = 2 * z.words > total


def parse(page: str) -> list[tuple[str, object, str]]:
    """The page as (kind, element, text) tokens; text holds the words of a stretch
    of one block, or the name of a tag."""
    root = Element("html", None, False, False, False)
    now, out, at = root, [], 0

    def close_to(element):
        return element.parent or root

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        raw = m[0]
        if raw[0] != "<" or raw == "<":
            out.append(("text", now, raw))
            continue
        if m[1] is None:
            continue
        tag, attrs = m[1].lower(), m[2]
        if raw[1] == "/":
            out.append(("tag", now, tag))
            e = now
            while e is not None and e.tag != tag:
                e = e.parent
            if e is not None and e is not root:
                now = close_to(e)
            continue
        if tag in RAW:
            if not raw.endswith("/>"):
                end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(page, at)
                at = end.end()
            continue
        if tag in ENDS_PARAGRAPH:
            e = now
            while e is not None and e.tag not in BLOCK:
                e = e.parent
            if e is not None and e.tag == "p":
                now = close_to(e)
        if tag in CLOSES:
            e = now
            while e is not None and e.tag not in CLOSES[tag] and e.tag not in CLOSE_LIMIT[tag]:
                e = e.parent
            if e is not None and e.tag in CLOSES[tag]:
                now = close_to(e)
        out.append(("tag", now, tag))
        if tag in VOID or raw.endswith("/>"):
            continue
        if tag in ("html", "body"):
            if tag == "body" and now.tag in ("html", "head"):
                now = Element("body", root, False, False, False)
            continue
        inside, e = False, now
        while e is not None and not inside:
            inside = e.tag in CONTENT_TAGS
            e = e.parent
        header = now.header or (tag == "header" and inside)
        never, marked = _is_aside(tag, attrs, inside)
        aside = now.aside or (tag == "header" and not inside) or never
        now = Element(tag, now, aside, now.link or tag == "a", header, marked)
    _weigh_zones(out)
    return out


def block_of(e: Element) -> Element:
    while e.parent is not None and e.tag not in BLOCK:
        e = e.parent
    return e


def dropped(e: Element, region: Element | None = None) -> bool:
    """Not main text: in an aside zone, in a marked zone that does not hold the region's element,
    or in an article's header but no heading."""
    if e.aside or any(region is None or not _within(region, z) for z in _zones(e)):
        return True
    return _in_header(e)


def _in_header(e: Element) -> bool:
    if not e.header:
        return False
    while e is not None and e.tag not in HEADINGS:
        e = e.parent
    return e is None


def word_kind(e: Element) -> str:
    if e.aside or _in_header(e):
        return "word aside"
    if any(_zones(e)):
        return "word marked"
    if e.link:
        return "word link"
    tag = block_of(e).tag
    return "word " + ("heading" if tag in HEADINGS else tag if tag in ("p", "li") else "other")


def _within(e: Element | None, outer: Element) -> bool:
    while e is not None and e is not outer:
        e = e.parent
    return e is outer


def labelled_counts(page: str) -> Counter | None:
    """(kind, inside content) counts of a page with exactly one content element."""
    tokens = parse(page)
    marked = {id(x): x for _, e, _ in tokens for x in _ancestors(e) if x.tag in CONTENT_TAGS and not x.aside and not any(_zones(x))}
    outer = [x for x in marked.values() if not any(_within(x.parent, y) for y in marked.values())]
    if len(outer) != 1:
        return None
    counts: Counter = Counter()
    for kind, e, text in tokens:
        inside = _within(e, outer[0])
        if kind == "text":
            counts[word_kind(e), inside] += len(text.split())
        else:
            counts["tag " + text, inside] += 1
    return counts


def _ancestors(e: Element | None):
    while e is not None:
        yield e
        e = e.parent


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of lying inside the content, within +-LIMIT; tags are never positive."""
    out = dict(DEFAULT_WEIGHTS)
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1))
        odds = max(-LIMIT, min(LIMIT, odds))
        out[kind] = min(TAG_AT_MOST, odds) if kind.startswith("tag ") else odds
    out["word aside"] = min(out["word aside"], DEFAULT_WEIGHTS["word aside"])
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and one past the last of the contiguous run with the highest sum (the first
    such run); (0, 0) if no score is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str, weights: dict[str, float]) -> str:
    tokens = parse(page)
    text = _region_text(tokens, weights)
    if not text:
        marked = [z for _, e, _ in tokens for z in _zones(e)]
        if marked:
            for z in marked:
                z.wide = True
            text = _region_text(tokens, weights)
    return text


def _region_text(tokens: list[tuple[str, Element, str]], weights: dict[str, float]) -> str:
    words = [len(t.split()) if k == "text" else 0 for k, _, t in tokens]
    scores = [weights.get(word_kind(e), 0.0) * n if k == "text" else weights.get("tag " + t, DEFAULT_TAG)
              for (k, e, t), n in zip(tokens, words)]
    lo, hi = best_region(scores)
    if lo == hi:
        return ""
    common = None
    for (k, e, _), n in zip(tokens[lo:hi], words[lo:hi]):
        if n and not e.aside and not _in_header(e):
            b = block_of(e)
            if common is None:
                common = b
            while not _within(b, common):
                common = common.parent
    if common is None:
        return ""
    while common.tag not in CONTAINERS:
        common = common.parent
    if common.tag not in ("html", "body"):
        while common.parent is not None and common.tag not in CONTENT_TAGS and any(x.tag in CONTENT_TAGS for x in _ancestors(common.parent)):
            common = common.parent
        lo, hi = 0, len(tokens)
        inside = lambda e: _within(e, common)
    else:
        inside = lambda e: True
    blocks: list[list[str]] = [[]]
    for k, e, t in tokens[lo:hi]:
        if k == "tag":
            if t in BLOCK:
                blocks.append([])
            elif t == "br":
                blocks[-1].append(" ")
        elif inside(e) and not dropped(e, common):
            blocks[-1].append(t)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
    return "\n".join(x for x in lines if x)


def fit_weights(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from about ``sample_pages`` pages, picked by a hash of the url and page_id."""
    rows = pages.where(F.col("html").isNotNull())
    n = rows.count()
    u = F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce(F.col("page_id").cast("string"), F.lit(""))), F.lit(1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in text_column(batch, "html").to_pylist():
                total.update(labelled_counts(page) or {})
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()),
                                          pa.array(list(total.values()), pa.int64())], names=["kind", "inside", "n"])

    some = rows.where(u < F.lit(1e6 * sample_pages / max(n, 1))).select("html")
    counts = some.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    found = {(r[0], r[1]): r[2] for r in counts.collect()}
    return weights_from(found) if found else dict(DEFAULT_WEIGHTS)


def extract_main_text(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``pages`` (html, ..) with text and n_chars (code points)."""
    kept = pages.select(*[c for c in pages.columns if c not in ("text", "n_chars")])
    rest = [c for c in kept.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(p, weights) for p in text_column(batch, "html").to_pylist()]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=[*rest, "text", "n_chars"])

    schema = T.StructType([*[kept.schema[c] for c in rest], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return kept.mapInArrow(run, schema)
