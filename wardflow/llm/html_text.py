"""Main text of HTML pages by line-block distribution.

Markup is stripped into one line per block element; what a page declares as furniture (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) leaves a blank line behind.
Lines weigh what they are long, links nothing, and the lines of a marked article enough to surge by
themselves.  The weights are summed over a sliding window: where the sum surges the main text
begins, where it dives to nothing it ends, and the lines between are kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, pick, strings

WINDOW = 3
SURGE = 80
#: Unmarked prose of more than so many times the marked text is not left out for the marks.
PART = 2

# Element names of the HTML standard and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset(
    "head nav header footer aside form button select option label fieldset menu dialog audio video "
    "datalist".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form "
    "toolbar tablist status".split()
)
NAMES = re.compile(
    r"(?:ads?|adsbygoogle|adslot|dfp|nav|navi|menus?|foot|aside|topbar|rail|toc|notices?|alert|"
    r"gdpr|popup|modal|overlay|login|signin|signup|register|respond|repl(?:y|ies)|related|hidden|"
    r"search|copyright|toolbar|pager|paging|widgets?|social|disqus|feedback|"
    r"comment(?:s|list|form|box|area|section|thread)?|share(?:s|d|bar|this|buttons?|links?)?|sharing|"
    r"recommend(?:ed|s|ations?)?)"
    r"|(?:advert|banner|sponsor|promo|breadcrumb|sidebar|footer|header|masthead|navbar|navigation|"
    r"cookie|consent|disclaimer|newsletter|subscri|pagination|outbrain|taboola|paywall).*"
)
# Names of reader comments: the only ids that count on parts of a marked article.
COMMENTS = re.compile(r"comment(?:s|list|form|box|area|section|thread)?|respond|replies|disqus")
# Elements of a text whose ids are made of its headings, as tables of contents need them.
ANCHORED = HEADINGS | frozenset("section p dl dt dd ul ol li figure table blockquote pre span a".split())
# Words after which such a name tells of a neighbour, as in "with-sidebar".
BESIDE = frozenset(("has", "with", "no", "without"))
# First parts of class names of an article that tell what it is about, as in "category-social".
ABOUT = frozenset("category tag tags topic section type format status".split())
# Elements whose end tags may be left out.
ENDLESS = frozenset("li dd dt option p td th tr tbody thead tfoot".split())
# Of these, only headings inside a marked article are kept.
HEADER_NAMES = re.compile(r"header.*|masthead.*")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?i)\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_HIDING = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_PARTS = re.compile(r"[^a-z]+")


def _kind(tag: str, attributes: str, named: bool = True, inside: bool = False) -> str:
    """``"furniture"``, ``"header"`` (its headings may belong to an article) or ``""``.

    Names of an article count if ``named``, but neither those of headers nor of its subjects.  On
    the parts of a text ``inside`` a marked article an id is an anchor, whatever word it is.
    """
    if tag in ("header", "hgroup"):
        return "header"
    if tag in FURNITURE:
        return "furniture"
    if not attributes or attributes.isspace() or tag in ("html", "body", "main"):
        return ""
    if tag == "article" and not named:
        return ""
    found = ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "furniture"
        if name == "style" and _HIDING.search(value) or name == "role" and value in ROLES:
            return "furniture"
        if name in ("class", "id"):
            if tag == "article":
                value = " ".join(v for v in value.split() if _PARTS.split(v)[0] not in ABOUT)
            parts = _PARTS.split(value)
            names = COMMENTS if name == "id" and inside and tag in ANCHORED else NAMES
            if names is COMMENTS and tag in HEADINGS:
                continue
            for before, part in zip(["", *parts], parts, strict=False):
                if before not in BESIDE and names.fullmatch(part):
                    if HEADER_NAMES.fullmatch(part):
                        found = found if tag == "article" else "header"
                    else:
                        found = found or "furniture"
    return found


class Line(NamedTuple):
    """A block of a page: characters in links, whether in a marked article, whether a title."""

    text: str
    linked: int = 0
    inside: bool = False
    title: bool = False


class _Lines:
    """Lines of a page, from its events; every open element is found in constant time."""

    def __init__(self, closed: set[int], holding: set[int], named: bool) -> None:
        self.closed, self.holding, self.named = closed, holding, named  # starts, by number
        self.begun: list[int] = []  # numbers of the starts in the stack
        self.marks: list[int] = []  # heights of the articles outside furniture
        self.lines: list[Line] = []
        self.stack: list[str] = []
        self.at: dict[str, list[int]] = {}  # heights of the open elements of each name
        self.blocks: list[int] = []  # heights of the open blocks but paragraphs
        self.pieces: list[str] = []
        self.linked = 0
        self.title = False
        self.skip: int | None = None  # height of the stack at the furniture being left out
        self.header = False  # the furniture is a header

    def text(self, part: str) -> None:
        if self.skip is not None and not (self.header and self.marks and self._in_heading()):
            return
        part = html.unescape(part)
        self.pieces.append(part)
        self.title |= bool(self.at.get("h1"))
        if self.at.get("a"):
            self.linked += len(part.split() and part.strip())

    def _in_heading(self) -> bool:
        return any(heights[-1] >= self.skip for h in HEADINGS if (heights := self.at.get(h)))

    def end_line(self) -> None:
        if self.pieces:
            line = " ".join("".join(self.pieces).split())
            if line:
                self.lines.append(Line(line, self.linked, bool(self.marks), self.title))
            self.pieces, self.linked, self.title = [], 0, False

    def blank(self) -> None:
        self.lines.append(Line(""))

    def _cut(self, height: int) -> None:
        """Close every element above ``height``."""
        for tag in reversed(self.stack[height:]):
            self.at[tag].pop()
        while self.blocks and self.blocks[-1] >= height:
            self.blocks.pop()
        del self.stack[height:]
        del self.begun[height:]
        while self.marks and self.marks[-1] >= height:
            self.marks.pop()
        if self.skip is not None and height <= self.skip:
            self.skip, self.header = None, False
            self.blank()

    def _close_open(self, tag: str) -> None:
        """Close what a start tag ends: an open paragraph, or an earlier item of the same list."""
        inner = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",)}
        ends = inner.get(tag, ()) + (("p",) if tag in BLOCKS else ())
        height = max((self.at[t][-1] for t in ends if self.at.get(t)), default=-1)
        # A block that was opened since keeps what is around it open.
        if height >= 0 and not (self.blocks and self.blocks[-1] > height):
            self._cut(height)

    def start(self, tag: str, attributes: str, number: int) -> None:
        if tag in BLOCKS:
            self.end_line()
            self._close_open(tag)
        elif tag == "br":
            self.text(" ")
        kind = ""
        if self.skip is None or tag in ("article", "main"):
            # A form around the article is no furniture for being a form.
            shown = "div" if number in self.holding else tag
            kind = _kind(shown, attributes, self.named, bool(self.marks))
        if tag in ("article", "main") and not kind:
            if self.skip is not None and self.begun[self.skip] not in self.closed:
                self._cut(self.skip)  # furniture that was never closed
            if self.skip is None:
                self.marks.append(len(self.stack))
        if tag in VOID:
            return
        if self.skip is None and kind:
            self.end_line()
            self.skip, self.header = len(self.stack), kind == "header"
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS and tag != "p":
            self.blocks.append(len(self.stack))
        self.stack.append(tag)
        self.begun.append(number)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        if heights := self.at.get(tag):
            self._cut(heights[-1])


def _outline(events: list[tuple]) -> tuple[set[int], set[int], set[str]]:
    """Numbers of starts that are closed by their own end, of forms around an article, and names
    of elements that are left open."""
    closed, holding, left = set(), set(), set()
    stack: list[tuple[str, int]] = []
    open_of: dict[str, int] = {}
    forms: list[int] = []  # open, without an article so far

    def cut(height: int, own: bool) -> None:
        for k in range(len(stack) - 1, height - 1, -1):
            tag, number = stack.pop()
            open_of[tag] -= 1
            if forms and forms[-1] == number:
                forms.pop()
            if own and k == height or tag in ENDLESS:
                closed.add(number)
            else:
                left.add(tag)

    for number, (_, tag, attributes) in enumerate(events):
        if attributes is None:
            if open_of.get(tag):
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), True)
        elif tag and tag not in VOID:
            if tag in ("article", "main"):
                holding.update(forms)
                forms.clear()
            elif tag == "form":
                forms.append(number)
            if tag in BLOCKS and open_of.get("p") and stack[-1][0] == "p":
                cut(len(stack) - 1, True)
            stack.append((tag, number))
            open_of[tag] = open_of.get(tag, 0) + 1
    left.update(t for t, _ in stack)
    return closed, holding, left


def _events(page: str) -> list[tuple]:
    """Texts as (text, "", ""), start tags as ("", tag, attributes), end tags as ("", tag, None)."""
    events: list[tuple] = []
    at = 0
    while match := _TAG.search(page, at):
        if match.start() > at:
            events.append((page[at : match.start()], "", ""))
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            events.append(("", tag, None))
        elif tag in RAW:
            if not match[3].endswith("/"):
                close = re.compile(rf"(?i)</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)").search(page, at)
                at = close.end() if close else len(page)
        else:
            events.append(("", tag, match[3]))
    if at < len(page):
        events.append((page[at:], "", ""))
    return events


def page_lines(page: str) -> list[Line]:
    events = _events(page)
    marked = any(tag in ("article", "main") for _, tag, _ in events)
    closed, holding, left = _outline(events) if marked else (set(), set(), set())

    def read(closed: set[int], named: bool) -> list[Line]:
        lines = _Lines(closed, holding, named)
        for number, (text, tag, attributes) in enumerate(events):
            if not tag:
                lines.text(text)
            elif attributes is None:
                lines.end(tag)
            else:
                lines.start(tag, attributes, number)
        lines.end_line()
        return lines.lines

    def size(lines: list[Line]) -> int:
        return sum(len(x.text) for x in lines)

    found = read(closed, True)
    if marked and not any(x.inside and x.text for x in found):
        unsure = {n for n in closed if events[n][1] in left}
        if unsure:
            # An end may have closed another element than it was meant for: the larger text tells.
            other = read(closed - unsure, True)
            found = other if size(other) > 3 * size(found) else found
        if not size(found):
            found = read(closed - unsure, False)  # a name that misleads
    return found


def line_weights(lines: list[Line], surge: int = SURGE) -> np.ndarray:
    """Lengths of the lines as the distribution counts them: what the tags say is evidence.

    Lines that are mostly links count nothing.  Where the page marks its article, lines outside it
    count nothing either, and lines inside it count as a surge each, links included, unless the
    marked lines are a small part of the prose: then the marks are not of the main text.
    """
    sizes = np.array([len(x.text) for x in lines], np.int64)
    links = np.array([2 * x.linked > len(x.text) for x in lines], bool)
    inside = np.array([x.inside for x in lines], bool)
    prose = np.where(links | ~inside & (sizes < surge), 0, sizes)
    marked = (sizes[inside] > 0).any() and PART * prose[inside].sum() >= prose[~inside].sum()
    if marked:
        return np.where(inside & (sizes > 0), np.maximum(sizes, surge), 0)
    return np.where(links, 0, sizes)


def main_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between surges and dives of the windowed weight.

    The text begins where the sum over the next ``window`` lines surges, or, where only short lines
    part it from a title, at the title; it ends where the sum dives to nothing.  A page on which
    nothing surges begins at its largest sum.
    """
    weights = line_weights(lines, surge)
    if not weights.any():
        return []
    sums = np.concatenate([[0], np.cumsum(np.append(weights, np.zeros(window, np.int64)))])
    sums = (sums[window:] - sums[:-window]).tolist()
    least = min(surge, max(sums))
    kept, start, done = [], None, 0
    for i, total in enumerate([*sums[: len(lines)], 0]):
        if start is None and total >= least:
            start, j = i, i
            while j > done and weights[j - 1]:
                j -= 1
                start = j if lines[j].title else start
        elif start is not None and total == 0:
            kept += [lines[j].text for j in range(start, i) if weights[j]]
            start, done = None, i
    return kept


def extract_text(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    Blocks are joined in page order by two line feeds; white space inside a block is one space and
    character references are decoded.  A null or empty page, and a page without main text, has the
    empty text.  Unclosed, misnested and cut-off markup is read as far as it goes.  Null ids and
    urls are kept, equal rows are extracted each on their own, other columns are ignored, an empty
    table yields no rows.  Nothing is shuffled.
    """
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = ["\n\n".join(main_lines(page_lines(p))) for p in strings(rows[2])]
            yield batch(
                schema, (rows[0].to_pylist(), rows[1].to_pylist(), texts, [len(t) for t in texts])
            )

    pages = pick(df, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
