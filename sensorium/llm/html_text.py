"""Main-text extraction by line-block distribution.

A page is cut into lines at block-level tags, without markup. Lines inside elements that hold no
article text (menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, scripts, styles) weigh
nothing, nor do lines made of links. The weights are summed over sliding windows of ``WINDOW`` lines:
the text begins where the sums surge and ends where they dive to nothing for good, and all lines with
weight between these points are kept, with the lines before the surge that adjoin it in its own element, and those of the last line's own
element after the dive. A name counts by its words: "ad", "comments" in any compound, "share", "related" only beside words of page
building. A header that opens an article element belongs to it. <article> and <main> elements bound the search, and then any sum is a surge,
unless the sums show that the rest of the page holds the text and they hold little. An article element counts as the others do:
inside a part that holds no article text, or where its own names say so (teaser, comment), it is left out.

Pages are independent: Arrow batches, no shuffle.

Defined results: null html counts as empty and gives an empty text; null urls and ids are returned as they are;
repeated rows are each extracted; a very long page is read whole; an empty table gives no rows; further columns are ignored; markup cut off at the end
is dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

WINDOW = 3
#: Without an article element: a surge needs so many characters, or this part of the largest sum.
SURGE_CHARS, SURGE_PART = 80, 0.25
#: The rest of the page is the article where its largest sum and its weight are so many times those of all article elements.
OUTWEIGHS = 2
#: So many of the elements around a line are known of it.
DEPTH = 32

#: HTML elements.
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
                   "tfoot th thead title tr ul".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math object".split())
#: Offsets are the page's own: lower() can lengthen a text.
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I | re.A) for name in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("head nav header footer aside form menu button select option label dialog fieldset".split())
_LINE = _BLOCK | _SKIP
#: Elements that one of their own kind ends.
_SELF = frozenset("p li dt dd tr td th option".split())
#: Elements that hold an article or a part of it, with what leads up to it.
_HOLDERS = frozenset("article body center div main section td".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id or role that name something else than the article, in whatever compound.
_OTHER = frozenset("ad ads advert adverts advertisement advertisements advertising advertorial adsense banner sponsor sponsors sponsored promo promos promotion "
                   "navigation nav navbar menu menus menubar breadcrumb breadcrumbs sidebar sidebars masthead footer cookie cookies consent gdpr popup popups "
                   "modal newsletter comment comments commentlist disqus pagination contentinfo complementary "
                   "werbung anzeige anzeigen publicidad anuncio anuncios publicite kommentar kommentare comentario comentarios commentaire commentaires".split())
#: Words that do so alone or beside words of page building only ("share-buttons", but not "market-share").
_OTHER_ALONE = frozenset("side aside rail widget widgets header foot notice notices alert alerts overlay subscribe subscription signup login share sharing social "
                         "related recommended teaser teasers replies reply respond discussion pager tags toolbar search form skip".split())
_BUILDING = frozenset("site page main global top bottom left right inner outer upper lower first last new small large big mobile desktop fixed sticky floating js wp "
                      "blog post posts article articles entry entries story stories news content text title titles heading link links list lists item items "
                      "button buttons btn icon icons bar box area wrapper wrap container holder block blocks section sections region zone panel group row col "
                      "column columns grid card cards module unit slot media image images user reader author to the more this by read input field label "
                      "nav primary secondary tertiary".split())
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[^\W\d_]+")
_LACKS = frozenset("no has with without hide".split())
_MAIN = re.compile(r"(?:role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody\b)", re.I)
_NAMES = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Class names of an article that tell its subject.
_TOPIC = re.compile(r"(?:^|(?<=\s))(?:category|cat|tag|topic|section|format|type|status)-\S+", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f\v\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class _Lines:
    """Lines of a page: text, weight, whether an article element holds them, the tags of the holders around them,
    and whether they are headings."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, tuple[int, ...], bool]] = []
        self._text: list[str] = []
        self._linked = 0

    def add(self, text: str, linked: bool) -> None:
        self._text.append(text)
        if linked:
            self._linked += len(_SPACE.sub(" ", text).strip())

    def pending(self) -> bool:
        return any(t.strip() for t in self._text)

    def end(self, skipped: bool, inside: bool, holders: list[int], heading: bool) -> None:
        if self._text:
            text = _SPACE.sub(" ", "".join(self._text)).strip()
            if text:
                # a paragraph may link a few words, a menu's line is links only
                weight = 0 if skipped or (self._linked >= 0.8 * len(text) and not inside) else len(text)
                self.lines.append((text, weight, inside, tuple(holders), heading))
            elif skipped:
                self.lines.append(("", 0, inside, (), False))
            self._text, self._linked = [], 0


def _is_other(name: str, attributes: str, whole: bool = False) -> bool:
    if name in _SKIP:
        return True
    if not attributes or name in ("html", "body"):
        return False
    named = " ".join(x for m in _NAMES.findall(attributes) for x in m if x)
    if whole:
        named = _TOPIC.sub(" ", named)
    return any(map(_names_other, named.split())) or bool(_HIDDEN.search(attributes))


def _names_other(name: str) -> bool:
    """Whether one class, id or role names something else than the article; "has-sidebar" says what is beside it."""
    parts = [x.lower() for x in _PARTS.findall(name)]
    told = [x for before, x in zip(["", *parts], parts, strict=False) if before not in _LACKS]
    if not _OTHER.isdisjoint(told):
        return True
    alone = any(x in _OTHER_ALONE for x in told)
    return alone and all(x in _OTHER_ALONE or x in _BUILDING or x.isdigit() or len(x) == 1 for x in parts)


def _tags(page: str) -> list[tuple[str, str, bool, str | None]]:
    """(text before the tag, name, closing, attributes) of each tag; attributes are None for a raw element, the name is "" for no tag."""
    out, at = [], 0
    while m := _TOKEN.search(page, at):
        text, at = page[at:m.start()], m.end()
        name = (m[2] or m[5] or "").lower()
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if m[5] and at >= len(page) and not page.endswith(">"):
            return [*out, (text, "", False, "")]  # cut off inside a tag
        if name in _RAW:
            if not closing:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
            attributes = None
        out.append((text, name, closing, attributes))
    return [*out, (page[at:], "", False, "")]


def _partners(tags: list[tuple[str, str, bool, str | None]]) -> dict[int, int]:
    """Opening and closing tags of a name that belong together, both ways."""
    opened: dict[str, list[int]] = {}
    out = {}
    for i, (_, name, closing, _) in enumerate(tags):
        if not closing:
            opened.setdefault(name, []).append(i)
        elif opened.get(name):
            out[i] = k = opened[name].pop()
            out[k] = i
    return out


class _Open(NamedTuple):
    """An open element: kind is "skip", "whole" (an article element) or "" (any other)."""

    name: str
    tag: int
    kind: str


class _Stack:
    """The open elements of a page. Firm ones are article and skipped elements that have a closing tag of their own."""

    def __init__(self, partners: dict[int, int]):
        self.partners, self.open = partners, []
        self.of: dict[str, list[int]] = {}  # places of the open elements of a name
        self.at: dict[int, int] = {}  # place of an open tag
        self.firm: list[int] = []
        self.holders: list[int] = []  # tags
        self.wholes = self.headings = 0
        self.skip = -1  # place of the outermost skipped element

    def push(self, name: str, tag: int, kind: str) -> None:
        place = len(self.open)
        self.open.append(_Open(name, tag, kind))
        self.of.setdefault(name, []).append(place)
        self.at[tag] = place
        self.wholes += kind == "whole"
        self.headings += name in _HEADINGS
        if name in _HOLDERS:
            self.holders.append(tag)
        if kind and tag in self.partners:
            self.firm.append(place)
        if kind == "skip" and self.skip < 0:
            self.skip = place

    def cut(self, size: int) -> None:
        """Leaves the outermost ``size`` elements open."""
        while len(self.open) > size:
            e = self.open.pop()
            self.of[e.name].pop()
            del self.at[e.tag]
            self.wholes -= e.kind == "whole"
            self.headings -= e.name in _HEADINGS
            if e.name in _HOLDERS:
                self.holders.pop()
        while self.firm and self.firm[-1] >= size:
            self.firm.pop()
        if self.skip >= size:
            self.skip = -1

    def find(self, name: str, tag: int) -> int:
        """The place of the element that a closing tag ends, with what is open inside, or -1. It doesn't end a firm
        element of another name, unless it belongs to an article or skipped element around that."""
        place = self.of[name][-1] if self.of.get(name) else -1
        if not self.firm or self.firm[-1] <= place:
            return place
        own = self.at.get(self.partners.get(tag, -1), -1)
        return own if own >= 0 and self.open[own].kind else -1

    def unclosed(self) -> bool:
        """Whether every skipped element seems to lack its closing tag (or took that of an element around it)."""
        lacking: set[str] = set()
        for e in self.open:
            if e.tag not in self.partners:
                lacking.add(e.name)
            elif e.kind == "skip" and e.name not in lacking:
                return False
        return True


def lines_of(page: str) -> list[tuple[str, int, bool, tuple[int, ...], bool]]:
    out, tags = _Lines(), _tags(page)
    stack, links, seen = _Stack(_partners(tags)), 0, False  # seen: an article began
    begun = 0  # lines when the latest article element began

    def inline() -> bool:
        return stack.skip >= 0 and stack.open[stack.skip].name not in _LINE  # left out of a line, which goes on

    def end() -> None:
        if not inline():
            out.end(stack.skip >= 0, stack.wholes > 0, stack.holders[-DEPTH:], stack.headings > 0)

    for i, (text, name, closing, attributes) in enumerate(tags):
        if text and stack.skip < 0:
            out.add(html.unescape(text), links > 0)
        elif text.strip() and not inline():
            out.add("x", False)  # the place of what is left out
        if not name:
            continue
        block = name in _LINE
        if attributes is None:
            if block:
                end()
        elif closing:
            k = stack.find(name, i)
            if inline() and 0 <= k < stack.skip:
                stack.cut(stack.skip)
            if block or (k >= 0 and stack.open[k].kind == "whole"):
                end()
            if k >= 0:
                stack.cut(k)
            if name == "a" and stack.skip < 0:
                links = max(0, links - 1)
        else:
            whole = name in ("article", "main") or bool(_MAIN.search(attributes))
            # a header that opens an article element holds its headline
            opens = name == "header" and stack.skip < 0 and stack.wholes > 0 and not any(w for _, w, *_ in out.lines[begun:]) and not out.pending()
            other = name not in _VOID and _is_other("" if opens else name, attributes, whole)
            if block and inline() and stack.open[stack.skip].tag not in stack.partners:
                stack.cut(stack.skip)
            if block or whole:
                end()
            if name in _SELF and stack.open and stack.open[-1].name == name:
                stack.cut(len(stack.open) - 1)
            if stack.skip >= 0 and whole and not other and not seen and stack.unclosed():
                stack.cut(stack.skip)  # the article begins: what came before was never closed
            if name not in _VOID:
                kind = "skip" if other else "whole" if whole and stack.skip < 0 else ""
                links += name == "a" and stack.skip < 0 and not other
                seen |= kind == "whole"
                begun = len(out.lines) if kind == "whole" else begun
                if block or kind or stack.of.get(name):
                    stack.push(name, i, kind)
            elif name == "br" and stack.skip < 0:
                out.add(" ", False)
    if inline():
        stack.cut(stack.skip)
    end()
    return out.lines


def _sums(weights: list[int]) -> list[int]:
    """Of the windows that begin at each line."""
    sums, total = [], sum(weights[:WINDOW])
    for i, w in enumerate(weights):
        sums.append(total)
        total += (weights[i + WINDOW] if i + WINDOW < len(weights) else 0) - w
    return sums


def main_text(page: str) -> str:
    """The article's blocks, one line each."""
    lines = lines_of(page)
    weights, rest = [w if inside else 0 for _, w, inside, _, _ in lines], [0 if inside else w for _, w, inside, _, _ in lines]
    # article elements beside a main text many times as dense are teasers or comments
    bounded = any(weights) and not (max(_sums(rest)) > OUTWEIGHS * max(_sums(weights)) and sum(rest) > OUTWEIGHS * sum(weights))
    weights = weights if bounded else rest
    if not any(weights):
        return ""
    sums = _sums(weights)
    surge = 1 if bounded else min(SURGE_CHARS, max(1, SURGE_PART * max(sums)))
    first = next(i for i, s in enumerate(sums) if s >= surge)
    # what leads up to the surge within its window belongs to it
    first = _lead(lines, weights, next(i for i in range(first, len(weights)) if weights[i]))
    last = max(i for i, s in enumerate(sums) if s >= surge)
    dive = next((i for i in range(last, len(sums)) if not sums[i]), len(sums))
    dive = _tail(lines, weights, max(i for i in range(dive) if weights[i]), dive)
    return "\n".join(line[0] for line, w in zip(lines[first:dive], weights[first:dive], strict=True) if w)


def _lead(lines: list[tuple[str, int, bool, tuple[int, ...], bool]], weights: list[int], first: int) -> int:
    """The surge's start, taken back over the adjoining lines of its holder (headline, byline, standfirst, verses),
    and over those of the holder around that from their first heading on."""
    own = lines[first][3]
    start = first
    while start and weights[start - 1] and (not own or own[-1] in lines[start - 1][3]):
        start -= 1
    around, headed = start, start
    while around and weights[around - 1] and (len(own) < 2 or own[-2] in lines[around - 1][3]):
        around -= 1
        if lines[around][4]:
            headed = around
    return headed


def _tail(lines: list[tuple[str, int, bool, tuple[int, ...], bool]], weights: list[int], last: int, dive: int) -> int:
    """The dive point, taken on to the last line of the same holder: links within an article don't end it. What lies in the page's
    body without a holder of its own ends at the dive."""
    own = lines[last][3]
    if len(own) < 2:
        return dive
    return max([dive, *(i + 1 for i in range(dive, len(lines)) if weights[i] and own[-1] in lines[i][3])])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    prepare(pages)
    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [f"{c} {picked.schema[c].dataType.simpleString()}" for c in ("id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p or "") for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    out = picked.mapInArrow(run, f"{', '.join(kinds)}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
