"""Main text of web pages by tag-path ratios.

A page's text nodes are gathered by root-to-leaf tag path (tags with their class and id words), apart for each
container that they lie in. A path's text length and its punctuation are smoothed along the tree: the container's
sums count half, those of the next one up a quarter, and so on (a marked article is one container), so that
headings and cells share in the text around them. Both are fused by a product in which punctuation counts a
fourth as much. Evidence against a path (an advert's name, a footer, a place outside the marked article) halves its
fused ratio each; where a page has little text, and ratios say little, it counts for more. Paths that reach the page's threshold
are the content; it lies in the widest gap that the page's own ratios leave between ``LOW`` and ``HIGH`` of the best one.

Left out beforehand is only what by its tag or its whole name can never be article text: scripts, styles, head, navigation,
menus, dialogs, forms, sidebars, page headers, notices, readers' comments, sharing and signup boxes.

Defined cases: null or empty html gives an empty text, an empty table no rows; repeated rows and blocks are kept as
often as they come; unclosed and stray tags, a missing ``</head>`` and broken quotes are tolerated; an
unclosed script, style or comment runs to the end of the page; other columns of the pages don't matter.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm import _text as t

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|iframe|svg|title|button|option|object|canvas)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>\"']*)((?>[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/<>\"']*)([^<>]*)>",  # a quote that isn't closed: the tag ends at the next bracket
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: elements that end an open element of the second set, as browsers do
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody"}, "option": {"option"}}
SCOPE = frozenset("ul ol table dl article section div main body".split())
CONTAINER = frozenset("article main section div body td".split())
#: never article text
NEVER_TAGS = frozenset("nav form menu dialog head aside".split())
_PLACES = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|mobile|desktop|post|blog|article|entry|content)"
#: whole class, id and role names of elements that are never article text
NEVER_NAMES = re.compile(
    rf"^(?:{_PLACES}[-_])?(?:nav(?:bar|igation)?|menus?|menubar|breadcrumbs?|sidebars?|widgets?|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay"
    r"|newsletter|subscribe|signup|login|comments?|commentlist|disqus|social|share|sharing|pagination|pager|toolbar)$"
    r"|^(?:cookie|consent|gdpr)[-_](?:banner|notice|bar|consent|popup|message|policy)$"
    r"|^comments?[-_](?:list|area|section|form|body|thread|\d+)$|^(?:user|reader)[-_]comments?$|^(?:share|social|sharing)[-_](?:buttons?|bar|links|icons|media|share|tools)$"
    r"|^newsletter[-_](?:signup|form|box|widget)$|^related[-_](?:posts|articles|links|stories|content|news)$|^(?:complementary|banner|contentinfo|search|dialog)$"
)
#: tags and whole names that speak against a path
DOUBTED_TAGS = frozenset("footer".split())
DOUBTED_NAMES = re.compile(rf"^(?:{_PLACES}[-_])?(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed|s)?|promo(?:tion)?s?)$|^(?:ads?|advert|sponsored|promo)[-_](?:slot|container|banner|box|unit|wrapper|block|content|space|label|top|bottom|\d+)$")
#: and those that do outside of an article only
DOUBTED_OUTSIDE = re.compile(rf"^(?:{_PLACES}[-_])?(?:header|masthead|footer|side|search|reply|replies|respond|discussion|related|recommended|copyright|legal|skip|hidden|skip-link|tagline)$")
#: characters of text below which evidence counts for more than a half
ENOUGH = 600
#: punctuation's part in the fused ratio
MARKS_POWER = 0.25
#: shares of the best path's fused ratio between which the threshold lies
LOW, HIGH = 0.03, 0.18
_COMMENT = re.compile(r"^comments?$|^comment[-_]")
_PUNCTUATION = re.compile(r"[.,;:!?…。，]")


def _judged(tag: str, names: list[str], in_article: bool, nested: bool) -> tuple[bool, int]:
    """(never article text, evidence against it) of an element; ``nested``: within an article."""
    if tag == "article":  # an article within an article is a reader's comment
        return nested or any(_COMMENT.match(n) for n in names), 0
    if tag in ("html", "body", "main"):
        return False, 0
    never = tag in NEVER_TAGS or tag == "header" and not in_article or any(NEVER_NAMES.match(n) for n in names)
    doubted = tag in DOUBTED_TAGS or any(DOUBTED_NAMES.match(n) or not in_article and DOUBTED_OUTSIDE.match(n) for n in names)
    return never, int(doubted)


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    never: bool
    doubts: int
    in_article: bool
    #: the containers' numbers, the outermost first; of an article only its own
    holders: tuple[int, ...]


class _Open(NamedTuple):
    tag: str
    step: str
    never: bool
    doubts: int
    in_article: bool
    nested: bool
    holders: tuple[int, ...]


_TOP = _Open("", "", False, 0, False, False, ())


def blocks(page: str) -> list[Block]:
    """The page's blocks of text, in page order."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    where: Block | None = None
    containers = 0

    def flush() -> None:
        nonlocal where
        if parts:
            if text := " ".join("".join(parts).split()):
                out.append(where._replace(text=text))
            parts.clear()
        where = None

    def add(text: str) -> None:
        nonlocal where
        top = stack[-1] if stack else _TOP
        if where is None or (where.never, where.doubts) != (top.never, top.doubts):
            if not text.strip():
                if parts:
                    parts.append(text)
                return
            if where is not None:
                flush()
            where = Block(tuple(s.step for s in stack if s.tag in BLOCK), "", top.never, top.doubts, top.in_article, top.holders)
        parts.append(text)

    def pop_to(k: int) -> None:
        if any(s.tag in BLOCK for s in stack[k:]):
            flush()
        del stack[k:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(_html.unescape(page[at : m.start()]))
        at = m.end()
        closing, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
            else:
                if tag in BLOCK:
                    flush()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK or tag == "body":
            for k, s in enumerate(stack):  # content ends the head
                if s.tag == "head":
                    pop_to(k)
                    break
                if s.tag in BLOCK and s.tag != "html":
                    break
        if tag in BLOCK:
            for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in SCOPE:
                    break
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in CLOSES[tag]:
                        pop_to(k)
                        break
                    if stack[k].tag in SCOPE:
                        break
            flush()
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        names = [n.lower() for x in _NAMES.findall(attributes) for n in "".join(x).split()] if attributes else []
        top = stack[-1] if stack else _TOP
        article = top.in_article or tag in ("article", "main")
        never, doubts = _judged(tag, names, top.in_article, top.nested)
        holders = top.holders
        if tag in CONTAINER and tag != "body" and not top.in_article:
            containers += 1
            holders = (*holders, containers)
        stack.append(_Open(tag, ".".join([tag, *names]), top.never or never, top.doubts + doubts, article, top.nested or tag == "article", holders))
    if at < len(page):
        add(_html.unescape(page[at:]))
    flush()
    return out


def _key(b: Block) -> tuple:
    return b.path, b.holders, b.doubts, b.in_article


def path_ratios(found: list[Block]) -> dict[tuple, float]:
    """Each path's text length and punctuation, smoothed along the tree and fused."""
    own, inside = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for b in found:
        size, marks = len(b.text), len(_PUNCTUATION.findall(b.text))
        for total in (own[_key(b)], *(inside[h] for h in b.holders)):
            total[0] += size
            total[1] += marks
    fused = {}
    for key, (size, marks) in own.items():
        for up, h in enumerate(reversed(key[1]), 1):
            size, marks = size + inside[h][0] * 0.5**up, marks + inside[h][1] * 0.5**up
        fused[key] = size * (1 + marks) ** MARKS_POWER
    return fused


def judged_ratios(found: list[Block], ratios: dict[tuple, float]) -> dict[tuple, float]:
    """The ratios after the evidence against their paths."""
    marked = any(b.in_article and not b.doubts for b in found)
    factor = 0.5 * min(1.0, sum(len(b.text) for b in found) / ENOUGH) ** 3
    return {key: r * factor ** (key[2] + (marked and not key[3])) for key, r in ratios.items()}


def page_threshold(ratios: list[float]) -> float:
    """In the middle of the widest gap between two ratios that follow each other, of which the lower one is below ``HIGH`` of the
    largest; between ``LOW`` and ``HIGH`` of it in any case."""
    best = max(ratios)
    shares = sorted({max(LOW, r / best) for r in ratios} | {LOW, 1.0})
    lo, hi = max(((a, b) for a, b in zip(shares[:-1], shares[1:], strict=True) if a < HIGH), key=lambda x: x[1] / x[0])
    return best * min(HIGH, (lo * hi) ** 0.5)


def main_text(page: str | None, threshold: float | None = None) -> str:
    """The page's article: the blocks of the paths whose fused ratio reaches the threshold, one a line.

    ``threshold``: a share of the best path's ratio, instead of the page's own.
    """
    found = [b for b in blocks(page or "") if not b.never]
    if not found:
        return ""
    fused = judged_ratios(found, path_ratios(found))
    least = page_threshold(list(fused.values())) if threshold is None else threshold * max(fused.values())
    return "\n".join(b.text for b in found if fused[_key(b)] >= least)


def extract(pages: DataFrame, threshold: float | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    t.tuned(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h.as_py(), threshold) for h in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
