"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events. Its text is cut into lines, one for each run of text between block
tags, and every line is counted: characters, those of them in links, and tags. The ratio of plain characters to tags is
smoothed along the page by a Gaussian, and a threshold between two clusters of the smoothed ratios tells content lines from
others. The element that holds the content lines is the content region; its lines are the text, short ones and
headings included.

Elements that are no article by their tag, role or class (menus, footers, adverts, comments and the like) are left out
before lines are counted, so that a long advert doesn't draw the region to itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, without

# Elements of HTML and the words that pages use for their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
NEVER_TEXT = frozenset(
    "applet audio button canvas datalist dialog embed head iframe input label legend map math menu noembed noframes noscript "
    "object optgroup option progress script select style svg template textarea title video".split()
)
APART = frozenset("aside footer nav search".split())
ROLES_APART = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS_APART = frozenset(
    "ad adbanner adbox ads adsense adslot advert advertisement advertisements advertising adverts alert alerts announcement banner "
    "breadcrumb breadcrumbs colophon comment commentlist comments consent cookie cookies copyright crumbs dfp discussion disqus drawer "
    "feedback footer gdpr interstitial lightbox login masthead menu menus modal nav navbar navigation navigations newsletter notice "
    "notices offcanvas outbrain overlay pager paginator pagination paywall popular popup promo promos promotion recommendations "
    "recommended related replies reply respond search share sharebar sharing shares sidebar sidebars signup skip social sponsor "
    "sponsored sponsors subscribe subscription taboola tagcloud toolbar topbar trending usercomments widget widgets".split()
)
WORDS_OF_ADVERTS = frozenset("ad ads advert advertisement sponsored".split())
WORDS_OF_OTHER_ARTICLES = frozenset("ad advert advertisement comment promo related reply sponsored".split())
WORDS_OF_HEADLINES = frozenset("article content entry page post story".split())
#: Class names that tell about the page's layout or its subject, not what the element is.
_ABOUT = re.compile(r"(?:has|no|with|without|tag|tags|category|cat|topic)[-_]", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be the content region.
CONTAINERS = frozenset("article body center dd div form header html li main section table tbody td tr".split())
#: Parts that an article may well stand in on badly closed pages or where a form wraps everything.
OPEN_TO_ARTICLES = frozenset("form header nav".split())
#: An element that closes an open one before it, and where the search for that one ends.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_TOKEN = re.compile(r"[A-Za-z0-9]+")
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Open elements beyond which nesting is no longer followed, as browsers do it.
DEEPEST = 512
SIGMA = 1.0
RADIUS = 3
#: Clusters are two if the ratio of one is four times that of the other.
APART_BY = math.log(4)
#: Share of the content that an article among several, or an inner element, must hold to be taken for the region.
MOST = 0.5
NEARLY_ALL = 0.95


@dataclass(frozen=True, slots=True)
class Line:
    """A run of text between block tags; ``path`` numbers the containers around it, outermost first."""

    text: str
    linked: int
    tags: int
    path: tuple[int, ...]
    heading: bool

    @property
    def plain(self) -> int:
        return max(0, len(self.text) - self.linked)


@dataclass(frozen=True, slots=True)
class Element:
    """An open element. One that stands in a menu, form or header may still hold the article; other parts that are left out may not."""

    tag: str
    path: tuple[int, ...]
    left_out: bool = False
    in_doubt: bool = False
    in_article: bool = False

    @property
    def silent(self) -> bool:
        return self.left_out or self.in_doubt


def words_of(name: str) -> list[str]:
    """The words of a class or id, by its marks and, after these, by its capitals too."""
    return [w.lower() for w in [*_TOKEN.findall(name), *_WORD.findall(name)]]


def is_apart(tag: str, attrs: Sequence[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element is no part of an article by its tag, role, class or id."""
    if tag in NEVER_TEXT or tag in APART or tag == "form" or (tag == "header" and not in_article):
        return True
    given = {name: value or "" for name, value in attrs}
    if "hidden" in given or given.get("aria-hidden") == "true" or _HIDDEN.search(given.get("style", "")):
        return True
    if tag in ("html", "body", "main"):
        return False
    if given.get("role", "").strip().lower() in ROLES_APART:
        return True
    names = [n for n in [*given.get("class", "").split(), given.get("id", "")] if n and not _ABOUT.match(n)]
    if tag == "article":  # its classes mostly tell what it is about
        return any(words_of(n)[:1] and words_of(n)[0] in WORDS_OF_OTHER_ARTICLES for n in names)
    words = {w for n in names for w in words_of(n)}
    if tag not in BLOCKS:
        return not words.isdisjoint(WORDS_OF_ADVERTS)
    if {"content", "wrap"} <= words:
        return False
    if "header" in words and not in_article and not words & WORDS_OF_HEADLINES:
        return True
    return not words.isdisjoint(WORDS_APART)


class PageLines(HTMLParser):
    """Collects the lines of a page that aren't left out, and the numbers of its article and main elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.articles: list[int] = []
        self.mains: list[int] = []
        self.wholes: list[int] = []
        self.containers = 0
        self.open = [Element("", ())]
        self.beyond = 0  # open elements that are nested too deep to be followed
        self.parts: list[str] = []
        self.linked = self.tags = 0
        self.in_link = False

    def read(self, html: str) -> None:
        self.feed(html)
        if _CUT_OFF.match(self.rawdata):  # the page ends within a tag
            self.rawdata = ""
        self.close()
        self.flush()

    def parse_html_declaration(self, i: int) -> int:
        """As the base class, but a comment without end takes the rest and odd sections are skipped."""
        if self.rawdata.startswith("<!--", i):
            if self.rawdata.find("-->", i + 4) < 0:
                return len(self.rawdata)
        elif self.rawdata.startswith("<![", i):
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else len(self.rawdata)
        return super().parse_html_declaration(i)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            heading = any(e.tag in HEADINGS for e in self.open)
            self.lines.append(Line(text, self.linked, max(1, self.tags), self.open[-1].path, heading))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        silent = self.open[-1].silent
        self.tags += not silent
        if tag == "a":
            self.in_link = True
        if tag in BLOCKS or tag == "main":
            self.flush()
            if not self.beyond:
                self.close_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if len(self.open) > DEEPEST:
            self.beyond += 1
            return
        above = self.open[-1]
        in_doubt = above.in_doubt and tag not in ("article", "main")
        apart = not (above.left_out or in_doubt) and is_apart(tag, attrs, above.in_article)
        left_out = above.left_out or (apart and tag not in OPEN_TO_ARTICLES)
        in_doubt = in_doubt or (apart and not left_out)
        path = above.path
        if tag in CONTAINERS:
            self.containers += 1
            path = (*path, self.containers)
            if tag in ("html", "body"):
                self.wholes.append(self.containers)
            if not (left_out or in_doubt):
                if tag == "article" and not above.in_article:
                    self.articles.append(self.containers)
                elif tag == "main" or ("role", "main") in attrs:
                    self.mains.append(self.containers)
        elif tag not in BLOCKS and not (left_out or in_doubt):
            return  # an inline element changes nothing
        self.open.append(Element(tag, path, left_out, in_doubt, above.in_article or tag in ("article", "main")))

    def close_implied(self, tag: str) -> None:
        """Closes what HTML lets a page leave open: the head, a paragraph, an item or a cell."""
        if tag != "head":
            self.close_element("head")
        if self.open[-1].tag == "p" or (self.open[-1].tag in HEADINGS and tag in HEADINGS | {"p", "div"}):
            self.open.pop()
        closed, ends = IMPLIED.get(tag, ((), ()))
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in ends:
                break
            if self.open[at].tag in closed:
                del self.open[at:]
                break

    def close_element(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                break

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in NEVER_TEXT and not self.beyond:
            self.close_element(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.open[-1].silent
        if tag in BLOCKS or tag == "main":
            self.flush()
        if tag in BLOCKS or tag == "a":
            self.in_link = False
        if self.beyond:
            self.beyond -= 1
        else:
            self.close_element(tag)

    def handle_data(self, data: str) -> None:
        if not self.open[-1].silent:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(" ".join(data.split()))


_KERNEL = [math.exp(-0.5 * (d / SIGMA) ** 2) for d in range(-RADIUS, RADIUS + 1)]


def smoothed(values: Sequence[float]) -> list[float]:
    """Gaussian means; beyond the ends there is nothing to weigh."""
    out = []
    for i in range(len(values)):
        low, high = max(0, i - RADIUS), min(len(values), i + RADIUS + 1)
        weights = _KERNEL[low - i + RADIUS : high - i + RADIUS]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def content_flags(lines: Sequence[Line]) -> list[bool]:
    """Which lines belong to the upper of two clusters of ratios, by themselves or smoothed; all of them if there is but one cluster.

    Lines that are made of links for the greater part never do.
    """
    own = [math.log1p(line.plain / line.tags) for line in lines]
    ratios = smoothed(own)
    low, high = min(ratios, default=0.0), max(ratios, default=0.0)
    while low < high:
        middle = (low + high) / 2
        under, over = [r for r in ratios if r < middle], [r for r in ratios if r >= middle]
        new = sum(under) / len(under), sum(over) / len(over)
        if new == (low, high):
            break
        low, high = new
    middle = (low + high) / 2 if high - low >= APART_BY else 0.0
    return [max(r, o) >= middle and 2 * line.linked < len(line.text) for r, o, line in zip(ratios, own, lines, strict=True)]


def content_lines(lines: Sequence[Line], articles: Sequence[int], mains: Sequence[int], wholes: Sequence[int]) -> list[Line]:
    """The lines of the content region, in page order.

    An article element is the region if it is the only one with text or holds most of the content; else the innermost
    container that holds nearly all of it, with headings right before it. Where only the whole page does, the region reaches from
    the first content line, with headings before it, to the last. Lines made of links don't belong to a region that is no article.
    """
    flags = content_flags(lines)
    weights: Counter[int] = Counter()
    sizes: Counter[int] = Counter()
    total = 0
    for line, flag in zip(lines, flags, strict=True):
        total += line.plain * flag
        for number in line.path:
            sizes[number] += len(line.text)
            weights[number] += line.plain * flag
    told = [a for a in articles if sizes[a]]
    article = max(told, key=lambda a: (weights[a], sizes[a], -a), default=None)
    if article is not None and (len(told) == 1 or weights[article] >= MOST * total):
        return [line for line in lines if article in line.path]
    main = max((m for m in mains if sizes[m]), key=lambda m: (weights[m], sizes[m], -m), default=None)
    chosen = [i for i, line in enumerate(lines) if main is None or main in line.path]
    inner = Counter(n for i in chosen for n in lines[i].path)
    total = sum(lines[i].plain for i in chosen if flags[i])
    holding = [n for n in inner if total and weights[n] >= NEARLY_ALL * total]
    region = max(holding, default=None)  # a container's number is higher than those of the containers around it
    if region is not None:
        chosen = [i for i in chosen if region in lines[i].path]
    chosen = [i for i in chosen if flags[i] or 2 * lines[i].linked < len(lines[i].text)]
    if total and (region is None or region in wholes):
        content = [i for i in chosen if flags[i]]
        chosen = [i for i in chosen if content[0] <= i <= content[-1]]
    first = chosen[0] if chosen else 0
    while first > 0 and lines[first - 1].heading:
        first -= 1
        chosen.insert(0, first)
    return [lines[i] for i in chosen]


def main_text(html: str | None) -> str:
    """The blocks of a page's content region, joined by an empty line; empty if there is none."""
    if not html:
        return ""
    page = PageLines()
    page.read(html)
    return "\n\n".join(line.text for line in content_lines(page.lines, page.articles, page.mains, page.wholes))


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None)

    return texts(html)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars``, its code points.

    Null and empty pages, and pages without text outside menus and the like, have an empty text. Pages are read whole,
    whatever their length, each by itself, so repeated rows give equal texts. Columns called ``text`` or ``n_chars`` are
    replaced; others stay, ``html`` too unless it has one of these names.
    """
    bounded_batches(pages.sparkSession)
    kept = [F.col(f"`{c}`") for c in without(pages, ["text", "n_chars"]).columns]
    found = pages.select(*kept, extracted(F.col(f"`{html}`")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
