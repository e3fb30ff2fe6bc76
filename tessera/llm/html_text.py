"""Main text of web pages by line-block distribution.

Method.  Markup is stripped and the page becomes lines, one for each block element, in page order.
Lines of boilerplate elements (menus, headers, footers, sidebars, notices, adverts, forms, comments),
told by tag, role or whole class and id names, weigh nothing and are never kept; nor is what scripts,
styles and the page's head hold.  A line weighs its characters, or nothing if it is mostly links and
no paragraph, as the lines of menus are.  The border of a container weighs nothing, but borders
between two lines outside boilerplate are left out.  The weights are summed over a window of WIDTH
lines that slides over the page.  Where the sum leaves zero a region begins, and it dives where the
sum is zero again; it surges if the sum reaches SURGE in between.  Regions that surge are kept, or the
densest one if none does, each from its first line of weight to its last, whatever the lines between
them hold, but for boilerplate.

Tags are a weight: a character inside article or main elements counts SURGE, so that any text there
surges; others count PLAIN, or one if the tagged text is half of the page's text or more, since what
stands beside such an article must be long to be part of it.

Cases.  Null or empty html, and pages without text, give the empty text.  Elements left open are
closed by the next closing container; a page cut off in a tag or comment ends there.  A form around an
article or main element is no boilerplate.  Character references are decoded; white space inside a
block becomes one space.  The time grows with the page's length, however broken or deeply nested it
is.  Rows that repeat are treated each.  Other columns pass unchanged; columns named text or n_chars
are replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 3
#: Window sum of a surge, and the weight of a character where tags tell nothing: 20 characters in a window then surge.
SURGE, PLAIN = 200, 10
#: Element names.
RAW = {"script", "style", "noscript", "template", "svg", "textarea", "iframe", "object", "head", "title", "select", "canvas", "math"}
AWAY = {"nav", "footer", "aside", "menu", "dialog", "button", "header", "label", "fieldset"}
BOXES = {"div", "section", "article", "main", "nav", "footer", "aside", "form", "header", "table", "body", "ul", "ol", "dl", "menu", "dialog", "fieldset", "figure", "td", "center", "button"}
HEADS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = BOXES | HEADS | {"p", "li", "dt", "dd", "pre", "blockquote", "tr", "th", "caption", "figcaption", "hr", "address", "details", "summary", "html", "legend", "option", "thead", "tbody", "tfoot"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Words of class and id names.  A name is boilerplate if one part is and all others are neutral, or if one part is sure.
BOILER_WORDS = {
    "ad", "ads", "banner", "comment", "consent", "cookie", "cookies", "footer", "header", "login", "menu", "modal", "nav", "navigation", "newsletter", "notice", "notices",
    "pager", "popup", "promo", "related", "replies", "respond", "search", "share", "sharing", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription",
    "toolbar", "topbar", "widget", "gdpr", "alert", "aside",
}
SURE_WORDS = {"advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "commentlist", "comments", "disqus", "navbar", "pagination", "sidebar"}
NEUTRAL_WORDS = {
    "site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "container", "wrapper", "wrap", "box", "bar", "area", "section", "block", "content",
    "inner", "outer", "list", "item", "items", "link", "links", "slot", "panel", "zone", "text", "body", "author", "form", "reader", "user", "buttons", "icons", "media", "posts", "stories", "policy", "the", "to", "js",
}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "alertdialog"}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# A quote opens a value only after an equals sign; possessive, so that no character is looked at twice.
_ATTRS = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"?+|'[^']*+'?+)?+)*+")
_ATTR = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>]++)))?+")
_PART = re.compile(r"[a-z]+")
_BORDER = object()


def _attributes(attrs: str) -> dict[str, str]:
    return {k.lower(): (a or b or c).lower() for k, a, b, c in reversed(_ATTR.findall(attrs))}  # the first of equal names counts


def _boiler_name(name: str, in_article: bool) -> bool:
    parts = {x for x in _PART.findall(name) if len(x) > 1}
    if in_article:
        parts.discard("header")  # an article's own header holds its title
    return bool(parts & SURE_WORDS or parts & BOILER_WORDS and parts <= BOILER_WORDS | NEUTRAL_WORDS)


def _boiler(name: str, attrs: dict[str, str], in_article: bool) -> bool:
    if name in AWAY and not (name == "header" and in_article):
        return True
    if name in ("body", "html", "main"):
        return False
    names = [*attrs.get("class", "").split(), *attrs.get("id", "").split()]
    if name == "article":
        return any({"comment", "comments"} & set(_PART.findall(x)) for x in names)
    if attrs.get("role") in BOILER_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    return any(_boiler_name(x, in_article) for x in names)


class Line:
    """A block's text, how much of it is linked, and where it stands."""

    __slots__ = ("text", "links", "off", "marked", "prose")

    def __init__(self, text: str, links: int, off: bool, marked: bool, prose: bool):
        self.text, self.links, self.off, self.marked, self.prose = text, links, off, marked, prose


def lines(page: str) -> list:
    """Blocks in page order, with _BORDER between containers."""
    out: list = []
    stack: list[tuple[str, int, int, int]] = []  # name, boilerplate, article, forms around an article
    still_open: Counter = Counter()
    buf: list[str] = []
    unclosed: set[str] = set()  # raw elements whose end tag the rest of the page lacks
    links = in_link = off = marked = forms = at = 0
    prose = False

    def flush() -> None:
        nonlocal links
        text = " ".join(_html.unescape("".join(buf)).split())
        if text:
            out.append(Line(text, links, off > 0 or forms > 0, marked > 0, prose))
        buf.clear()
        links = 0

    def pop() -> None:
        nonlocal off, marked, forms
        name, bad, art, around = stack.pop()
        still_open[name] -= 1
        off -= bad
        marked -= art
        forms = forms - (name == "form") + around

    def said(text: str) -> None:
        nonlocal links
        if text:
            buf.append(text)
            if in_link:
                links += len(text)

    end = len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            said(page[at:])
            break
        said(page[at:lt])
        if page.startswith("<!--", lt):
            gt = page.find("-->", lt + 4)
            at = end if gt < 0 else gt + 3
            continue
        closing = page.startswith("</", lt)
        m = _NAME.match(page, lt + 1 + closing)
        if not m:
            if closing or page.startswith(("<!", "<?"), lt):
                gt = page.find(">", lt)
                at = end if gt < 0 else gt + 1
            else:  # no tag
                said("<")
                at = lt + 1
            continue
        name, found = m[0].lower(), _ATTRS.match(page, m.end())
        at = found.end() + 1
        if at > end:
            break  # cut off in a tag
        attrs, alone = found[0], found[0].rstrip().endswith("/")
        if not closing and name in RAW and not alone:
            close = None if name in unclosed else re.compile(rf"</{name}\s*+>", re.I).search(page, at)
            if close is None:
                unclosed.add(name)
                if name == "head":
                    continue
            at = close.end() if close else end
            flush()
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name in BLOCKS:
            flush()
            prose = name == "p" and not closing
            if name in BOXES:
                out.append(_BORDER)
        if name == "br":
            buf.append(" ")
        if closing:
            if still_open[name]:
                top = len(stack) - 1
                while stack[top][0] != name and (name in BOXES or stack[top][0] not in BOXES):
                    top -= 1
                if stack[top][0] == name:
                    while len(stack) > top:
                        if stack[-1][1] and name not in BLOCKS:
                            flush()
                        pop()
        elif name not in VOID:
            last = stack[-1][0] if stack else ""
            if name in BLOCKS and (last == "p" or last in HEADS | {"li", "dt", "dd"} and (name == last or name in BOXES - {"td", "ul", "ol", "dl"} and last in HEADS)):
                pop()
            known = _attributes(attrs) if attrs.strip() else {}
            bad = _boiler(name, known, marked > 0)
            if name in BOXES or bad or name in ("p", "li"):
                if bad and name not in BLOCKS:
                    flush()
                if not alone:
                    art = int(name in ("article", "main") and not bad or known.get("role") == "main")
                    around = forms if art else 0
                    stack.append((name, int(bad), art, around))
                    still_open[name] += 1
                    off += bad
                    marked += art
                    forms += (name == "form") - around
    flush()
    return out


def regions(weights: list[int], surge: int = SURGE, width: int = WIDTH) -> list[tuple[int, int]]:
    """First and last weighted line of each region that surges, or of the densest one if none does."""
    found, begin, most, total = [], None, 0, sum(weights[: width - 1])
    for i in range(len(weights) + 1):  # total: the sum of the window that begins at line i
        total += weights[i + width - 1] if i + width - 1 < len(weights) else 0
        if total and begin is None:
            begin, most = i, 0
        most = max(most, total)
        if not total and begin is not None:
            found.append((most, begin, i - 1))  # the window before this one had weight in its first line alone
            begin = None
        total -= weights[i] if i < len(weights) else 0
    least = min(surge, max((m for m, _, _ in found), default=0))
    spans = [(a, z) for m, a, z in found if m >= least]
    return [(next(i for i in range(a, z + 1) if weights[i]), z) for a, z in (spans if least == surge else spans[:1])]


def main_text(page: str | None) -> str:
    found, borders = [], 0
    for x in lines(page or ""):  # borders between two lines outside boilerplate part nothing
        if x is _BORDER:
            borders += 1
            continue
        if x.off or not found or found[-1] is None or found[-1].off:
            found += [None] * min(borders, WIDTH)
        borders = 0
        found.append(x)
    inside = [x for x in found if x and not x.off]
    linked = lambda x: 2 * x.links > len(x.text) and not x.prose
    tagged, whole = sum(len(x.text) for x in inside if x.marked), sum(len(x.text) for x in inside if x.marked or not linked(x))
    plain = 1 if 2 * tagged >= whole else PLAIN

    def weight(x: Line | None) -> int:
        if x is None or x.off:
            return 0
        return len(x.text) * SURGE if x.marked else 0 if linked(x) else len(x.text) * plain

    kept = regions([weight(x) for x in found])
    return "\n".join(x.text for a, z in kept for x in found[a : z + 1] if x and not x.off)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text, and without html_col."""
    names = [c for c in pages.columns if c not in ("text", html_col)]
    schema = "".join(f"`{c}` {t}, " for c, t in pages.select(*names).dtypes) + "text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [main_text(t.as_py()) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(got, pa.string())], names=[*names, "text"])

    return pages.select(*names, html_col).mapInArrow(run, schema)


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    out = extracted(common.read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
