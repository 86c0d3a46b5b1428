"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events; a block element begins a new
line.  Each line has its text and the number of tags in it.  The ratios of the
two are smoothed with a Gaussian along the page and split into two clusters by
a threshold; the upper cluster marks content.  Where ``article`` and ``main``
hold most of the marked text, the innermost that holds nearly all of their text is
the content region, or all of them together; else it is the innermost element
that still holds nearly all marked text, widened to its parent where that one
goes on in pieces of the same kind (parts of lists and tables, sections,
elements alike in tag and class).  All lines of the region are returned, short
ones and links too; outside of an ``article`` or ``main``, only lists of links
at its two ends, and at the ends of the page single lines unlike the marked
ones, are not.  Menus, page headers, footers, sidebars, notices,
adverts, forms, comments of readers and what is never shown are left out
wherever they stand.  The name of a class or id is evidence only: what it names
stays if it holds an ``article`` or ``main`` or most of the marked text; so does
a form, without its controls.

Defined cases: null and empty html, and pages without text, give the empty
string; broken markup (elements that are never closed, stray end tags, cut-off
references) is read as the parser reads it, and what HTML lets end without a tag
(cells, rows, items, terms, paragraphs) ends there; time and memory follow the
length of the page, however many elements are open; a head that is not closed ends where
the body, an element that cannot stand in a head, or text begins; repeated rows are extracted each;
other columns are never read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

SIGMA = 1.0
#: Share of the marked text that landmarks must hold together; share of it, or of their text, that a region must hold.
LANDMARK_SHARE, REGION_SHARE = 0.5, 0.8
#: Share of the marked text from which on elements of one name are not left out for it.
NAMED_SHARE = 0.5
#: Share of text in links from which on a part at an end of the region is no content outside of landmarks.
LINKS = 0.6

# Names in HTML and their parts in it.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that may hold lines; a paragraph or heading is a line itself.
HOLDER = BLOCK - frozenset("dt dd h1 h2 h3 h4 h5 h6 hr li option p pre summary td th legend".split()) | {"li", "td", "th", "dd"}
#: What a start tag ends where it is still open, and the elements that this does not reach beyond.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    **dict.fromkeys(("dd", "dt"), (("dd", "dt"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("tr", "table"))),
    "tr": (("tr",), ("table",)),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (("tbody", "thead", "tfoot"), ("table",))),
}
#: A paragraph ends where a block begins, but not beyond these.
KEEPS_PARAGRAPH = ("table", "td", "th", "button", "object")
#: Parts of a text, never a page's whole content beside others of their kind.
PIECES = frozenset("section li dd dt tr tbody thead tfoot ul ol dl table blockquote figure details pre".split())
#: A single line of these is text even where it is a link.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote dd dt td th pre figcaption".split())
UNSEEN = frozenset("script style noscript template svg math iframe object canvas audio video map head title".split())
ASIDE = frozenset("nav footer aside dialog menu search button select textarea fieldset".split())
LANDMARK = frozenset(("article", "main"))
#: What may stand in a head; all else ends one that is open.
IN_HEAD = frozenset("head title base link meta style script noscript template".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion banner "
    "sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comment comments commentlist disqus respond widget widgets toolbar login pager pagination".split()
)
#: Names made of these alone tell comments, however many there are.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond".split())
COMMENT_PARTS = COMMENT_WORDS | frozenset("area block body box container content feed form item list section thread wrapper".split())
#: A name that begins with one of these tells how a page is laid out, not what the element is.
STATES = frozenset("has hide is no not show with without".split())
#: On an ``article``, only these count.
ARTICLE_WORDS = frozenset(("comment", "comments", "ad", "related"))
#: These count only outside of an article.
OUTER_WORDS = frozenset(("header",))
DIGITS = re.compile(r"\d+")
SPLIT_NAMES = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Line:
    __slots__ = ("text", "tags", "linked", "holder", "block")

    def __init__(self, text: str, tags: int, linked: int, holder: int, block: str):
        self.text, self.tags, self.linked, self.holder, self.block = text, tags, linked, holder, block


class LineReader(HTMLParser):
    """Collects the lines of a page that are not set aside.

    Elements are numbered as they open, from 1; 0 is the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents: list[int] = [0]
        #: Tag and class of each element.
        self.kinds: list[tuple[str, str]] = [("", "")]
        self.landmarks: set[int] = set()
        #: Elements that hold landmarks.
        self.holding: set[int] = set()
        #: Elements named like what is left out: a key of the name, and whether it tells comments.
        self.named: dict[int, tuple[tuple, bool]] = {}
        self._open: list[tuple[str, int, bool]] = []
        #: For each tag where in ``_open`` it stands.
        self._places: dict[str, list[int]] = defaultdict(list)
        self._aside = self._within = self._links = self._tags = self._linked = 0
        self._block = ""
        self._text: list[str] = []

    def _end_line(self, block: str = "") -> None:
        text = " ".join("".join(self._text).split())
        if text and not self._aside:
            self.lines.append(Line(text, self._tags, self._linked, self._open[-1][1] if self._open else 0, self._block))
        if text:
            self._tags = self._linked = 0
        self._text, self._block = [], block

    def _is_aside(self, tag: str, attrs: list) -> bool:
        if tag in ASIDE:
            return True
        if not attrs and tag != "header":
            return False
        if tag == "header":
            return self._within == 0
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "role" and (value or "").lower() in ASIDE_ROLES:
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _named(self, tag: str, attrs: list) -> tuple[tuple, bool] | None:
        """The key of the element's name and whether it tells comments, if it is named like what is left out."""
        if tag == "main":
            return None
        telling = ARTICLE_WORDS if tag == "article" else ASIDE_WORDS
        found = comments = False
        for name, value in attrs:
            if name in ("class", "id") and value:
                for part in value.split():
                    words = [w.lower() for w in SPLIT_NAMES.split(part) if w]
                    if not words or words[0] in STATES:
                        continue
                    bare = {w for w in words if not w.isdigit()}
                    comments |= bare <= COMMENT_PARTS and not bare.isdisjoint(COMMENT_WORDS)
                    found |= not telling.isdisjoint(bare) or (
                        tag != "article" and not OUTER_WORDS.isdisjoint(bare) and not self._within
                    )
        names = dict(attrs)
        if not found:
            return ((tag,), False) if tag == "form" or (names.get("role") or "").lower() == "form" else None
        return (tag, DIGITS.sub("", names.get("class") or names.get("id") or "")), comments

    def _end_head(self) -> None:
        if self._open and self._open[-1][0] == "head":
            self._close(("head",))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            self._close(("head",))
        elif tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCK:
            self._end_line(tag)
            self._close(("p",), KEEPS_PARAGRAPH)
        elif tag == "br":
            self._text.append(" ")
        if tag in ENDS:
            self._close(*ENDS[tag])
        self._tags += 1
        if tag == "a":
            self._links += 1
        if tag in VOID:
            return
        if tag in ("body", "html"):
            return
        aside = tag in UNSEEN or self._is_aside(tag, attrs)
        named = None if aside or self._aside else self._named(tag, attrs)
        if tag in HOLDER or aside or named:
            above, own = self._open[-1][1] if self._open else 0, len(self.parents)
            self.parents.append(above)
            self.kinds.append((tag, next((v or "" for n, v in attrs if n == "class"), "")))
            if named:
                self.named[own] = named
            elif tag in LANDMARK and not aside and not self._aside:
                self.landmarks.add(own)
                self._within += 1
                while above and above not in self.holding:
                    self.holding.add(above)
                    above = self.parents[above]
            self._places[tag].append(len(self._open))
            self._open.append((tag, own, aside))
            self._aside += aside

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def _close(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
        """Ends the innermost open element of ``tags``, and what is open inside it, but nothing beyond ``within``."""
        at = max((self._places[t][-1] for t in tags if self._places[t]), default=-1)
        if at < 0 or any(self._places[t] and self._places[t][-1] > at for t in within):
            return
        for tag, own, aside in reversed(self._open[at:]):
            self._places[tag].pop()
            self._aside -= aside
            self._within -= own in self.landmarks
        del self._open[at:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_line()
        self._tags += 1
        if tag == "a":
            self._links = max(0, self._links - 1)
        self._close((tag,), ENDS[tag][1] if tag in ENDS else ())

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        if not self._aside:
            self._text.append(data)
            if self._links:
                self._linked += len(data.strip())

    def finish(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the lines; the ends are repeated."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def upper_cluster(values: np.ndarray) -> np.ndarray:
    """The upper of two clusters: the threshold lies midway between their means."""
    low, high = values.min(), values.max()
    threshold = (low + high) / 2
    while True:
        upper = values >= threshold
        if upper.all():
            return upper
        again = (values[upper].mean() + values[~upper].mean()) / 2
        if abs(again - threshold) < 1e-9:
            return upper
        threshold = again


def _marked(lines: list[Line]) -> np.ndarray:
    return upper_cluster(smoothed(np.array([len(x.text) / max(1, x.tags) for x in lines])))


def _sums(parents: list[int], own: list[int]) -> list[int]:
    """For each element the sum over itself and all inside it; parents come before their children."""
    out = own[:]
    for k in range(len(out) - 1, 0, -1):
        out[parents[k]] += out[k]
    return out


def _inside(parents: list[int], some: set[int]) -> list[bool]:
    """For each element whether it or one around it is of ``some``."""
    out = [0 in some]
    for k in range(1, len(parents)):
        out.append(out[parents[k]] or k in some)
    return out


def _last(parents: list[int]) -> list[int]:
    """The last element inside each one; those inside are numbered from the element on."""
    out = list(range(len(parents)))
    for k in range(len(out) - 1, 0, -1):
        out[parents[k]] = max(out[parents[k]], out[k])
    return out


def _unnamed(lines: list[Line], reader: LineReader) -> list[Line]:
    """The lines without those in forms and in elements whose names tell that they are no content.

    Comments go if any marked text stays.  Other names may mislead: such
    elements go if those of the same name hold a minor share of the rest, and
    if the rest without all of them is more than a trifle.
    """
    named = {k: x for k, x in reader.named.items() if k not in reader.holding}
    if not named or not lines:
        return lines
    parents, marked = reader.parents, _marked(lines)
    comments = _inside(parents, {k for k, (_, spoken) in named.items() if spoken})
    spoken = np.array([comments[x.holder] for x in lines])
    gone = spoken if (marked & ~spoken).any() else np.zeros(len(lines), bool)
    texts, shown = [0] * len(parents), set()
    total = 0
    for line, mark, out in zip(lines, marked, gone):
        if not out:
            shown.add(line.holder)
            if mark:
                texts[line.holder] += len(line.text)
                total += len(line.text)
    held, shows = _sums(parents, texts), _sums(parents, [int(k in shown) for k in range(len(parents))])
    # an element within another of its name adds nothing
    weight: dict[tuple, int] = defaultdict(int)
    around: list[int] = []
    depth: dict[tuple, int] = defaultdict(int)
    for k in range(1, len(parents)):
        while around and around[-1] != parents[k]:
            left = around.pop()
            if left in named:
                depth[named[left][0]] -= 1
        around.append(k)
        if k in named:
            key = named[k][0]
            if shows[k] and not depth[key]:
                weight[key] += held[k]
            depth[key] += 1
    minor = sorted((key for key, w in weight.items() if w < NAMED_SHARE * total), key=lambda key: (weight[key], key), reverse=True)
    # names are given up from the weightiest on: a line comes back with the last of its names
    place = {key: i for i, key in enumerate(minor)}
    back = [0]
    for k in range(1, len(parents)):
        back.append(max(back[parents[k]], place.get(named[k][0], -1) + 1 if k in named else 0))
    again = np.zeros(len(minor) + 1, np.int64)
    for k, n in enumerate(texts):
        again[back[k]] += n
    enough = np.flatnonzero(np.cumsum(again) > (1 - REGION_SHARE) * total)
    given_up = int(enough[0]) if len(enough) else len(minor)
    return [x for x, out in zip(lines, gone) if not out and back[x.holder] <= given_up]


def _region(lines: list[Line], marked: np.ndarray, reader: LineReader) -> list[Line]:
    parents, last = reader.parents, _last(reader.parents)
    within = _inside(parents, reader.landmarks)
    total = sum(len(x.text) for x, mark in zip(lines, marked) if mark)
    inside = [x for x in lines if within[x.holder]]
    if sum(len(x.text) for x, mark in zip(lines, marked) if mark and within[x.holder]) > LANDMARK_SHARE * total:
        # among landmarks all text counts that is no link: lines of near lengths may be marked differently
        texts = [0] * len(parents)
        for x in inside:
            texts[x.holder] += max(0, len(x.text) - x.linked)
        held = _sums(parents, texts)
        named = [k for k in reader.landmarks if held[k] >= REGION_SHARE * held[0] and held[k]]
        # the innermost was opened last; several that share the text come together
        return [x for x in inside if not named or max(named) <= x.holder <= last[max(named)]]
    texts, links, counts, hits = ([0] * len(parents) for _ in range(4))
    for x, mark in zip(lines, marked):
        texts[x.holder] += len(x.text)
        links[x.holder] += x.linked
        counts[x.holder] += 1
        hits[x.holder] += len(x.text) * int(mark)
    texts, links, counts, hits = (_sums(parents, x) for x in (texts, links, counts, hits))
    region = max(k for k in range(len(parents)) if hits[k] >= REGION_SHARE * total)
    # the children of the elements around the region
    around, k = set(), region
    while k:
        k = parents[k]
        around.add(k)
    children: dict[int, list[int]] = defaultdict(list)
    for k in range(1, len(parents)):
        if parents[k] in around:
            children[parents[k]].append(k)
    kinds = reader.kinds

    def goes_on(one: int) -> bool:
        """Whether the parent of ``one`` has more of its kind."""
        tag, name = kinds[one]
        return tag in PIECES or any(
            k != one and kinds[k] == kinds[one] and counts[k] >= (1 if name or tag in ("td", "th") else 2) and links[k] < LINKS * texts[k]
            for k in children[parents[one]]
        )

    while region and goes_on(region):
        region = parents[region]
    # the region's parts: a child with all inside it, or a line
    below = [0] * len(parents)
    for k in range(1, len(parents)):
        below[k] = k if parents[k] == region else below[parents[k]]
    chosen = [x for x in lines if region <= x.holder <= last[region]]
    parts: list[tuple[int, list[Line]]] = []
    for x in chosen:
        part = below[x.holder] if x.holder != region else 0
        if part and parts and parts[-1][0] == part:
            parts[-1][1].append(x)
        else:
            parts.append((part, [x]))
    alike = {kinds[part] for part, _ in parts if part and hits[part]}

    def apart(part: int, held: list[Line]) -> bool:
        if part and hits[part]:
            return False
        if sum(x.linked for x in held) >= LINKS * sum(len(x.text) for x in held):
            return len(held) > 1 or held[0].block not in TEXT
        return region == 0 and len(held) == 1 and part != 0 and kinds[part] not in alike and kinds[part][0] not in PIECES

    marks = {id(x) for x, mark in zip(lines, marked) if mark}
    first, end = 0, len(parts)
    while first < end and apart(*parts[first]) and id(parts[first][1][0]) not in marks:
        first += 1
    while end > first and apart(*parts[end - 1]) and id(parts[end - 1][1][0]) not in marks:
        end -= 1
    return [x for _, held in parts[first:end] for x in held]


def main_blocks(html: str | None) -> list[str]:
    """The lines of the main text of a page, in order."""
    if not html:
        return []
    reader = LineReader()
    reader.feed(html)
    lines = _unnamed(reader.finish(), reader)
    return [x.text for x in _region(lines, _marked(lines), reader)] if lines else []


def main_text(html: Column) -> Column:
    @F.pandas_udf("array<string>")
    def blocks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_blocks(x) for x in batch], dtype=object)

    return blocks(html)


def extract_pages(pages: DataFrame, id: str = "page_id", html: str = "html", *keep: str) -> DataFrame:
    """One row for each row of ``pages``: the id, ``keep``, text, n_chars and the blocks."""
    ship(pages.sparkSession)
    return (
        pages.select(F.col(id), *keep, main_text(F.col(html)).alias("blocks"))
        .withColumn("text", F.concat_ws("\n", "blocks"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
