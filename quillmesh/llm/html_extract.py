"""Main text of web pages by line-block distribution.

The markup is stripped to lines, one a block element's text, each with its length
of running text; lines in menus, headers, footers, sidebars, notices, adverts,
forms, comments of readers and the like weigh nothing, and neither do menus of bare
links. A boilerplate element counts as one such line. Lines of nothing but links make no
surge, but stay within a block that has one, save for rows of them at its ends. On a page
that marks an article or main part, lines outside of it weigh OUTSIDE of their length.
Lengths are summed over sliding windows of lines. Dive points, where the sum of a window
falls to nothing or the weight of lines changes, part the page into blocks; a block with
a surge point, where the sum of a window passes the threshold, is main text with all its
lines that weigh anything, so short first and last paragraphs come with it. The
threshold is half the mean of the page's own sums, at most SURGE. So the sums decide on
every page; marks, names and roles only weigh.

Names are hints. Outside of an article one of the parts of a class or id may tell of
boilerplate; within it the whole name has to, and a paragraph or heading stays whatever
its name.

Scale: a projection over the pages, a page at a time, in linear time; no shuffle, and
batches bounded in bytes.

Defined results: null and empty pages have empty text; broken markup is read the way
browsers do (open elements end where their container ends, an unclosed script or
comment runs to the end); repeated rows are each extracted; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm._worker import releasing

#: Lines in a window, and the sum that is a surge on every page.
WINDOW = 3
SURGE = 80
#: Weight of a line outside of a marked article or main part.
OUTSIDE = 0.01
BATCH_BYTES = 2 << 20

#: Elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside audio button canvas dialog datalist footer form head iframe input label map menu nav noembed noframes noscript "
    "object script search select style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription teaser toolbar topbar widget widgets".split()
)
#: A name after one of these tells of a layout, not of the element itself.
NEGATING = frozenset("has with no without is show hide".split())
#: Parts of a name that say no more than that it is some element; with a name from above they make a whole name.
GENERIC = frozenset(
    "area bar block bottom box button buttons center container content form group holder icon icons inline inner item items left "
    "link links list main message page post right row section site slot top unit wrap wrapper".split()
)
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p".split())
LANDMARKS = frozenset("article main".split())
#: Elements within which a start tag ends its sibling.
HOLDERS = frozenset("ul ol dl table select div section article".split())
#: Start tags that end an open element of the same group.
ENDS = {t: frozenset([t]) for t in ("li", "option", "tr")} | {t: frozenset(["dt", "dd"]) for t in ("dt", "dd")} | {t: frozenset(["td", "th"]) for t in ("td", "th")}

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)|[^<]+|<""", re.S
)
_STOP = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NAME = re.compile(r"[a-z]+")


def _named(value: str, whole: bool, dropped: frozenset) -> bool:
    """Whether a class or id tells of boilerplate, by one of its parts or, if ``whole``, by all of it."""
    for one in value.split():
        names = _NAME.findall(_CAMEL.sub("-", one).lower())
        told = [n in dropped and (k == 0 or names[k - 1] not in NEGATING) for k, n in enumerate(names)]
        if any(told) and (not whole or all(t or n in GENERIC for t, n in zip(told, names, strict=True))):
            return True
    return False


def _boilerplate(tag: str, attributes: str, inside: str) -> bool:
    """Whether an element is no main text by its tag, role, class, id or, outside of an article, by being hidden."""
    article = inside in LANDMARKS
    if tag in DROPPED or tag == "header" and not article:
        return True
    if not attributes or not attributes.strip() or tag in ("html", "body", "main") or article and tag in PROSE:
        return False
    got = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if not article and ("hidden" in got or got.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", got.get("style", ""), re.I)):
        return True
    if got.get("role", "").lower() in DROPPED_ROLES:
        return True
    dropped = DROPPED_NAMES - {"header"} if article else DROPPED_NAMES  # an article's own header has its title
    return any(_named(got.get(k, ""), article, dropped) for k in ("class", "id"))


class Line:
    """Text of a block (empty for boilerplate), how much of it is link text, its element, and whether a marked article
    holds it."""

    __slots__ = ("text", "linked", "tag", "marked")

    def __init__(self, text: str, linked: int, tag: str, marked: bool) -> None:
        self.text, self.linked, self.tag, self.marked = text, linked, tag, marked


class _Open:
    """The open elements: each tag's places in the stack are kept, so that no step looks through all of it."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool]] = []  # (tag, boilerplate)
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.landmarks: list[str] = []
        self.dropped = self.marked = self.links = 0

    def push(self, tag: str, bad: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        if tag in LANDMARKS:
            self.landmarks.append(tag)
            self.marked += not bad
        self.stack.append((tag, bad))
        self.dropped += bad
        self.links += tag == "a"

    def cut(self, k: int) -> None:
        """Ends the elements from place ``k`` of the stack on."""
        while len(self.stack) > k:
            tag, bad = self.stack.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            if tag in LANDMARKS:
                self.landmarks.pop()
                self.marked -= not bad
            self.dropped -= bad
            self.links -= tag == "a"

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def block(self) -> str:
        return self.stack[self.blocks[-1]][0] if self.blocks else ""

    def make_room(self, tag: str) -> None:
        """Ends what the start of a block ends: an open paragraph, and a sibling such as the list item before."""
        if self.block() == "p":
            self.cut(self.blocks[-1])
        if tag in ENDS:
            sibling = self.last(ENDS[tag])
            if sibling > self.last(HOLDERS):
                self.cut(sibling)

    def end(self, tag: str) -> None:
        k = self.last([tag])
        if k >= 0 and (tag in BLOCK or not self.blocks or k > self.blocks[-1]):
            self.cut(k)


def _tag_end(page: str, at: int, ends: dict[str, int]) -> int:
    """Where the tag whose attributes start at ``at`` ends; a quote that is never closed is none."""
    while True:
        stop = _STOP.search(page, at)
        if stop is None:
            return len(page)
        if stop[0] == ">":
            return stop.end()
        if stop.start() >= ends[stop[0]]:
            found = page.find(">", stop.end())
            return len(page) if found < 0 else found + 1
        at = page.index(stop[0], stop.end()) + 1


def lines_of(page: str) -> list[Line]:
    """The page's lines in order, without markup and boilerplate elements."""
    out: list[Line] = []
    parts: list[str] = []
    links: list[str] = []
    tags = _Open()
    passed = False  # text of a boilerplate element, which leaves one empty line, however many blocks it has
    at, end = 0, len(page)
    quotes = {q: page.rfind(q) for q in "\"'"}

    def close_line() -> None:
        nonlocal passed
        if passed and not tags.dropped:
            out.append(Line("", 0, "", False))
            passed = False
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Line(text, len(" ".join(unescape("".join(links)).split())), tags.block(), tags.marked > 0))
            parts.clear()
            links.clear()

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        closing, opening = m[1], m[2]
        if opening is not None:
            tag, since = opening.lower(), at
            at = _tag_end(page, at, quotes)
            if tag in BLOCK:
                close_line()
                tags.make_room(tag)
            if tag == "br":
                if not tags.dropped:
                    parts.append(" ")
            elif tag in VOID:
                pass
            elif tag in RAW:
                found = _RAW_END[tag].search(page, at)
                at = found.end() if found else end
            else:
                tags.push(tag, _boilerplate(tag, page[since : at - 1], tags.landmarks[-1] if tags.landmarks else ""))
        elif closing is not None:
            tag = closing.lower()
            if tag in BLOCK:
                close_line()
            tags.end(tag)
        elif m[0].startswith(("<!", "<?")):
            continue
        elif tags.dropped:
            passed = passed or not m[0].isspace()
        else:
            parts.append(m[0])
            if tags.links:
                links.append(m[0])
    close_line()
    return out


def _links(lines: list[Line]) -> tuple[list[bool], list[bool]]:
    """(lines of nothing but links, those of them in menus): a menu is three or more in a row, no window of which is
    long enough for a surge; a list of references is."""
    bare = [x.text != "" and x.linked >= 0.9 * len(x.text) for x in lines]
    menu = [False] * len(lines)
    k = 0
    while k < len(lines):
        run = k
        while run < len(lines) and bare[run]:
            run += 1
        if run - k >= 3 and all(sum(len(x.text) for x in lines[i : i + WINDOW]) < SURGE for i in range(k, run - WINDOW + 1)):
            menu[k:run] = [True] * (run - k)
        k = max(run, k + 1)
    return bare, menu


def _blocks(held: list[bool], lines: list[Line]) -> list[list[int]]:
    """The lines held, parted at the dive points: a window of lines that aren't, or the bounds of a marked part."""
    out: list[list[int]] = []
    for k, h in enumerate(held):
        if h and out and k - out[-1][-1] <= WINDOW and lines[k].marked == lines[out[-1][-1]].marked:
            out[-1].append(k)
        elif h:
            out.append([k])
    return out


def _trimmed(block: list[int], lines: list[Line], bare: list[bool]) -> list[int]:
    """A block without the rows of links at its ends, which lead elsewhere; headings, paragraphs and lists of three or
    more links stay."""
    def loose(i: int) -> bool:
        return bare[i] and lines[i].tag not in PROSE and not any(all(bare[k : k + 3]) for k in range(max(i - 2, 0), min(i + 1, len(bare) - 2)))

    first, last = 0, len(block)
    while first < last and loose(block[first]):
        first += 1
    while first < last and loose(block[last - 1]):
        last -= 1
    return block[first:last]


def extract(page: str | None) -> str:
    """The main text of a page, its blocks joined by line feeds."""
    lines = lines_of(page or "")
    if not lines:
        return ""
    bare, menu = _links(lines)
    marked = any(x.marked for x in lines)
    held = [x.text != "" and not m for x, m in zip(lines, menu, strict=True)]
    weights = [
        (len(x.text) if h and (x.marked or not b) else 0) * (1 if x.marked == marked else OUTSIDE) for x, h, b in zip(lines, held, bare, strict=True)
    ]
    blocks = _blocks(held, lines)
    sums = [[sum(weights[i] for i in block[k : k + WINDOW]) for k in range(len(block))] for block in blocks]
    passed = [s for each in sums for s in each if s >= 1]
    if not passed:
        return ""
    surge = min(SURGE, sum(passed) / len(passed) / 2)
    kept: list[int] = []
    for block, each in zip(blocks, sums, strict=True):
        if max(each) >= surge:
            kept += block if lines[block[0]].marked else _trimmed(block, lines, bare)
    return "\n".join(lines[i].text for i in kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start, held, texts = 0, 0, []
        for k, page in enumerate(batch.column("html")):
            texts.append(extract(page.as_py()))
            held += len(texts[-1])
            if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                keys = [batch.column(n).slice(start, len(texts)) for n in ("page_id", "url")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(texts, pa.string())], ["page_id", "url", "text"])
                start, held, texts = k + 1, 0, []


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = ", ".join(f"{n} {slim.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))
    return slim.mapInArrow(releasing(_extracted), f"{kinds}, text string").withColumn("n_chars", F.length("text").cast("long"))
