"""Main text of web pages by text-to-tag ratios.

A parser takes a page in pieces as a stream of events and turns it into lines, one for each block of
text. A line's ratio is its characters, blanks and links aside, over its tags. A Gaussian smooths the ratios
over the neighbouring lines of the same section, so that a long article doesn't lift what stands
beside it, and lines whose smoothed ratio reaches the threshold are clusters of content. A section
with such a line is a content region and is taken whole, however short its other lines are.

Elements and names are features of that choice, not the choice: lines in an article or main element
count twice, and a cluster there selects that element; sections with a name such as `notice` count a
quarter and are taken only on their own. What can't be an article's text (menus, headers and footers
of pages, sidebars, adverts, forms, scripts, reader comments) has no ratio and is never content. Within
an article a name that only holds such a word (`comment-on-law`, `related-work`) counts half, and is
never content only if the section is made of repeated items or of links; headings are not judged by name.

Time is linear in a page's length, whatever is left open in it: what the parser cannot finish is
taken apart by a plain scan, in which an unclosed tag ends at the next `<`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .rows import map_lists

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: Share of the smoothed ratios' standard deviation that content reaches.
CUT = 1.0
#: Ratios beyond count as this, so that very long lines don't raise the threshold over ordinary ones.
CEILING = 80.0
#: Factors on the ratios of lines in article and main elements, in sections with a weak name, and in doubtful ones.
HELD, WEAK, DOUBTFUL = 2.0, 0.25, 0.5
#: From so many items of a kind, or this share of characters in links or in list items, on a doubtful section is no content.
ITEMS, LINKED, LISTED = 2, 0.4, 0.8
ITEM_TAGS = frozenset("article dd div li section".split())
#: Characters that the parser is given at a time.
FEED = 1 << 16

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks that are sections of a page.
SECTIONS = frozenset("html body article main div section center td".split())
#: Elements whose text is never content.
DROPPED = frozenset(
    "aside button canvas datalist dialog footer form head iframe label menu nav noembed noframes noscript object optgroup option script search "
    "select style svg template textarea title".split()
)
#: Words of class and id names, and roles, that mark such an element.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr hidden masthead menu modal nav navbar navigation newsletter pager pagination popup related replies reply respond sidebar signup "
    "sponsor sponsored subscribe subscription".split()
)
#: Classes of lists of what readers say; as an id, or on a section, they may be the text's own.
TALK = frozenset("discussion discussions feedback reactions responses thread".split())
#: Words that speak against a section without deciding.
WEAKLY = frozenset("notice notification promo promotion share sharing skip social toolbar widget widgets".split())
#: Words that mark even an element within a line of text.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense hidden sponsor sponsored".split())
#: Beside these a word says what is not there, or what else is on the page.
WITHOUT = frozenset("free has have no non not with without".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Elements that hold a page's own text; never dropped for their class.
HOLDERS = frozenset("html body article main".split())
#: Open elements that a new one of the kind ends.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_WORDS = re.compile(r"[a-z]+")
_TOKENS = re.compile(r"<[^<>]*>|<[^<>]*|[^<]+")
_MARKUP = re.compile(r"<[a-zA-Z/!?]")
_HEADING = re.compile(r"h[1-6]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def named(names: str, words: frozenset[str]) -> bool:
    """Whether one of the blank-separated class or id names begins or ends with one of `words`, and doesn't deny it."""
    for name in names.lower().split():
        parts = _WORDS.findall(name)
        if parts and (parts[0] in words or parts[-1] in words) and WITHOUT.isdisjoint(parts):
            return True
    return False


def decisive(names: str) -> bool:
    """Whether one of the class or id names is just a marked word."""
    return not MARKED.isdisjoint(names.lower().split())


@dataclass
class Section:
    """A section of a page: the one around it, the innermost article or main element it is or lies in, its name's weight.

    doubtful: its name holds a marked word; items: how often the elements in it have each tag and class.
    """

    parent: int
    holder: int
    weak: bool = False
    root: bool = False
    doubtful: bool = False
    items: dict[tuple[str, str], int] = field(default_factory=dict)


@dataclass
class Line:
    """A block of text: its parts as they come, the tags seen in it, its characters in links without blanks, and where it stands."""

    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    dropped: bool = False
    title: bool = False
    section: int = 0
    listed: bool = False
    text: str = ""


@dataclass
class Open:
    """An open element: whether its text is dropped, there as a part of a line, and its section."""

    tag: str
    dropped: bool
    inline: bool
    section: int


class Lines(HTMLParser):
    """Collects lines and sections from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.sections = [Section(-1, -1, root=True)]
        self.open = [Open("", False, False, 0)]
        self.count: dict[str, int] = {}
        self.line = Line()

    def _break(self) -> None:
        if self.line.parts:
            self.line.text = " ".join("".join(self.line.parts).split())
            if self.line.text:
                self.lines.append(self.line)
        at = self.open[-1]
        self.line = Line(tags=0 if self.line.text else self.line.tags, dropped=at.dropped, title=at.tag == "h1", section=at.section, listed=bool(self.count.get("li")))

    def _pop(self) -> Open:
        was = self.open.pop()
        self.count[was.tag] -= 1
        return was

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.line.parts.append(" ")
        block = tag in BLOCKS
        if block and not self.open[-1].inline:
            if self.open[-1].tag == "p":
                self._pop()  # a block ends an open paragraph
            if self.open[-1].tag in ENDS.get(tag, ()):
                self._pop()
            self._break()
        self.line.tags += 1
        if tag in VOID:
            return
        at = self.open[-1]
        section, inline, dropped = at.section, at.inline, at.dropped
        held = self.sections[section].holder >= 0
        weak = doubtful = False
        if not dropped:
            dropped = tag in DROPPED or (tag == "header" and not held)
            if attrs and not dropped:
                dropped, weak, doubtful = self._marks(tag, attrs, block, held)
            inline = dropped and not block
        if tag in ITEM_TAGS and self.sections[section].doubtful:
            items = self.sections[section].items
            kind = tag, next((v or "" for n, v in attrs if n == "class"), "")
            items[kind] = items.get(kind, 0) + 1
        if not dropped and (tag in SECTIONS or weak or doubtful):
            self.sections.append(Section(section, self.sections[section].holder, weak, tag in ("html", "body"), doubtful))
            section = len(self.sections) - 1
            if tag in ("article", "main"):
                self.sections[section].holder = section
        self.open.append(Open(tag, dropped, inline, section))
        self.count[tag] = self.count.get(tag, 0) + 1
        if block and not inline:
            self._break()
            self.line.tags += 1

    @staticmethod
    def _marks(tag: str, attrs: list[tuple[str, str | None]], block: bool, held: bool) -> tuple[bool, bool, bool]:
        """Whether attributes drop an element, whether they speak against it, and whether they leave that in doubt."""
        weak = doubtful = False
        for name, value in attrs:
            if tag in ("html", "body"):
                break
            if name == "hidden":
                return True, False, False
            if not value:
                continue
            if name in ("class", "id"):
                if tag in HOLDERS and not held or _HEADING.fullmatch(tag):
                    continue
                if tag in ("ins", "span") and named(value, ADVERTS):
                    return True, False, False
                if block and named(value, MARKED):
                    if not held or decisive(value):
                        return True, False, False
                    doubtful = True
                if block and name == "class" and tag != "section" and not TALK.isdisjoint(value.lower().split()):
                    return True, False, False
                weak |= block and named(value, WEAKLY)
            elif name == "role" and value.lower() in ROLES or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                return True, False, False
        return False, weak, doubtful

    def parse_html_declaration(self, i: int) -> int:
        """Declarations and marked sections end at the first `>` (CDATA at `]]>`), however odd they are."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        end = "]]>" if self.rawdata[i : i + 9].lower() == "<![cdata[" else ">"
        at = self.rawdata.find(end, i + 2)
        return at + len(end) if at >= 0 else -1

    def handle_endtag(self, tag: str) -> None:
        at = self.open[-1]
        if tag == "p" and not self.count.get("p"):
            if not at.inline:
                self._break()
            return
        self.line.tags += 1
        if not self.count.get(tag):
            return
        broken = False
        while True:
            if not broken and self.open[-1].tag in BLOCKS and not self.open[-1].inline:
                self._break()
                broken = True
            if self._pop().tag == tag:
                break
        if broken:
            self._break()

    def handle_data(self, data: str) -> None:
        if not self.open[-1].inline:
            self.line.parts.append(data)
            if self.count.get("a"):
                self.line.linked += len("".join(data.split()))


    def finish(self) -> None:
        """Takes what is left open at the end of a page, in one scan: an unclosed tag ends at the next `<` and is dropped."""
        left, self.rawdata = self.rawdata, ""
        for token in _TOKENS.findall(left):
            if self.cdata_elem:
                if not re.match(rf"</{self.cdata_elem}[\s/>]", token, re.IGNORECASE):
                    continue
            elif not _MARKUP.match(token):
                self.handle_data(unescape(token))
                continue
            if token.endswith(">"):
                self.feed(token)
                self.rawdata = ""  # a quote was left open
        self._break()


def parsed(html: str, feed: int = FEED) -> tuple[list[Line], list[Section]]:
    """The lines of a page, in order, and its sections."""
    parser, at = Lines(), 0
    while at < len(html):
        # What is still open is looked through again, so pieces grow with it.
        to = at + max(feed, len(parser.rawdata))
        parser.feed(html[at:to])
        at = to
    parser.finish()
    return parser.lines, parser.sections


def settle(lines: list[Line], sections: list[Section]) -> None:
    """Drops the lines of doubtful sections that are lists of items or of links, with all in them."""
    if not any(s.doubtful for s in sections):
        return
    size, linked, listed = ([0] * len(sections) for _ in range(3))
    for x in lines:
        n = len(x.text) - x.text.count(" ")
        size[x.section] += n
        linked[x.section] += x.linked
        listed[x.section] += n if x.listed else 0
    for i in range(len(sections) - 1, 0, -1):
        for total in (size, linked, listed):
            total[sections[i].parent] += total[i]
    gone = [False] * len(sections)
    for i, s in enumerate(sections):
        classed, items = (max([n for (t, c), n in s.items.items() if test(t, c)], default=0) for test in (lambda t, c: c, lambda t, c: t == "li"))
        repeats = classed >= ITEMS or items >= ITEMS and listed[i] >= LISTED * size[i] or linked[i] >= LINKED * max(1, size[i])
        gone[i] = s.doubtful and repeats or s.parent >= 0 and gone[s.parent]
    for x in lines:
        x.dropped |= gone[x.section]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios under a Gaussian window; the weights beyond the ends go to what is there."""
    if len(ratios) < 2:
        return ratios
    n = max(1, int(3 * sigma))
    window = np.exp(-0.5 * (np.arange(-n, n + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), window)[n : n + len(ratios)]
    return np.convolve(ratios, window)[n : n + len(ratios)] / weight


def clusters(lines: list[Line], sections: list[Section]) -> np.ndarray:
    """Whether each line's smoothed ratio reaches the page's threshold."""
    ratios = np.zeros(len(lines))
    members: dict[int, list[int]] = {}
    for i, x in enumerate(lines):
        if not x.dropped:
            s = sections[x.section]
            factor = (HELD if s.holder >= 0 else 1.0) * (WEAK if s.weak else 1.0) * (DOUBTFUL if s.doubtful else 1.0)
            ratios[i] = min(CEILING, max(0, len(x.text) - x.text.count(" ") - x.linked) / max(1, x.tags)) * factor
            members.setdefault(x.section, []).append(i)
    smooth = np.zeros(len(lines))
    for own in members.values():
        smooth[own] = smoothed(ratios[own])
    return (smooth > 0) & (smooth >= CUT * smooth.std())


def regions(lines: list[Line], sections: list[Section]) -> Iterator[Line]:
    """The lines of the sections that clusters select."""
    chosen: set[int] = set()
    for x, dense in zip(lines, clusters(lines, sections), strict=True):
        if dense:
            chosen.add(x.section)
            if not sections[x.section].weak and sections[x.section].holder >= 0:
                chosen.add(sections[x.section].holder)
    taken, around = [], set()
    for i, s in enumerate(sections):  # sections come after those around them
        inherits = s.parent >= 0 and not s.weak and not s.doubtful and not sections[s.parent].root and taken[s.parent]
        taken.append(i in chosen or inherits)
    for i in chosen:
        while (i := sections[i].parent) >= 0 and i not in around:
            around.add(i)
    untitled = not any(x.title and taken[x.section] and not x.dropped for x in lines)
    for x in lines:
        if not x.dropped and (taken[x.section] or untitled and x.title and x.section in around):
            yield x


def main_text(html: str | None) -> str:
    """The content lines of a whole page, joined by newlines."""
    lines, sections = parsed(html or "")
    settle(lines, sections)
    return "\n".join(x.text for x in regions(lines, sections)) if lines else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages`; html null or empty: empty text.

    Rows are taken each by itself, so repeated rows give repeated results and a page's size bounds
    the memory; columns beyond page_id, url and html are left out.
    """

    def run(columns: dict[str, list]) -> dict[str, list]:
        text = [main_text(h) for h in columns["html"]]
        return {"page_id": columns["page_id"], "url": columns["url"], "text": text, "n_chars": [len(t) for t in text]}

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_lists(rows, run, "page_id long, url string, text string, n_chars long")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
