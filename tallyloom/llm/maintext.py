"""Main text of web pages: parser events, text-to-tag ratios, smoothing and a threshold between two clusters.

The standard library's streaming parser turns a page into lines, one for each block of text, each with its number of
characters and of tags. The ratios of the two are smoothed by a Gaussian along the page, and a threshold halfway
between the means of their two clusters tells content lines from the rest. The content region is the innermost
container that holds all content lines, or the articles that do, with the headings and paragraphs beside it. All of
its lines belong to the article, short ones too, but those inside elements that the page itself marks as something
else: menus, forms, adverts, comments and the like. A mark on the wrapper of most of the page's content counts for
nothing.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that are no part of an article.
ASIDE = frozenset(
    "nav header footer aside form script style noscript template iframe object svg canvas audio video button select "
    "textarea input dialog menu title head".split()
)
#: Elements that may stand in a head; any other one ends it.
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
#: Words that say the same of any element, if a whole name in its class, id or role consists of them and of QUALIFIERS:
#: sidebar or cookie-notice, but not has-sidebar, comments-open or header-fixed, which tell something of a wrapper.
ASIDE_WORDS = (
    r"(?:ads?|advert[a-z]*|banner|breadcrumbs?|comments?|respond|disqus|cookies?|consent|notice|notification|popup|modal|"
    r"overlay|newsletter|subscribe|signup|login|menu|navbar|nav|navigation|pagination|pager|sidebar|side|widget|related|"
    r"recommended|promo[a-z]*|sponsor[a-z]*|share|sharing|social|toolbar|masthead|footer|header|contentinfo|complementary|"
    r"alert|search|skip)"
)
QUALIFIERS = (
    r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|sub|mobile|user|post|article|entry|story|text|"
    r"bar|box|block|area|section|column|col|row|list|item|links?|buttons?|icons?|media|form|panel|wrap|wrapper|container|"
    r"inner|outer|title|posts|articles|stories|slot|unit|space|leaderboard|google|div|gpt|thread|reply|\d+)"
)
ASIDE_NAME = re.compile(
    rf"(?!(?:page|post|article|entry|story)[_-]header$)(?:{QUALIFIERS}[_-]+)*{ASIDE_WORDS}(?:[_-]+(?:{ASIDE_WORDS}|{QUALIFIERS}))*|skip[_-].+",
    re.IGNORECASE,
)
#: Elements that begin and end a line.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the start of the keyed one ends, if they are open within the same container.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "p"}}
ARTICLE = frozenset({"article", "main"})
#: Elements that can be the content region; lists, tables, quotations and the like are parts of one.
REGION = ARTICLE | frozenset("html body div section center form fieldset details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre li dd table".split())
TEXTUAL = HEADINGS | PARAGRAPHS
#: Kinds of elements: what a MARKED one holds is no part of the article unless that is most of the page, what a HIDDEN
#: one holds never is.
PLAIN, MARKED, HIDDEN = range(3)
#: Factor on the smoothed ratio of lines in an article or main.
BONUS = 1.3
SIGMA = 1.0
RADIUS = 2


@dataclass(slots=True)
class Open:
    """An open element that matters. What a line needs to know of all open ones is kept by number, so that a line costs
    the same at any depth."""

    tag: str
    kind: int
    #: Where the elements begin that stand in the same block as this one, itself included unless it is a block.
    inline: int
    #: Is it, or what it stands in, HIDDEN?
    hidden: bool
    #: Number of the innermost MARKED element, and of the innermost one of REGION; 0 if there is none.
    mark: int
    region: int
    #: The headings and paragraphs among the open elements.
    within: frozenset[str]


OUTSIDE = Open("", 0, 0, False, 0, 0, frozenset())


@dataclass(slots=True)
class Line:
    text: str
    tags: int
    hidden: bool
    mark: int
    region: int
    within: frozenset[str]
    #: Is most of it in links?
    linked: bool


class Tree:
    """Elements by number, each opened after the one that it stands in; 0 stands for the page."""

    def __init__(self) -> None:
        self.parents = [0]
        #: The outermost article that an element is or stands in.
        self.articles = [0]

    def add(self, parent: int, article: bool = False) -> int:
        self.parents.append(parent)
        self.articles.append(self.articles[parent] or (len(self.parents) - 1) * article)
        return len(self.parents) - 1

    def summed(self, counts: dict[int, int]) -> list[int]:
        """Of every element what it and all those in it count."""
        out = [counts.get(n, 0) for n in range(len(self.parents))]
        for n in range(len(out) - 1, 0, -1):
            out[self.parents[n]] += out[n]
        return out

    def below(self, chosen: set[int]) -> list[bool]:
        """Is an element chosen, or does it stand in one that is?"""
        out = [0 in chosen]
        for n in range(1, len(self.parents)):
            out.append(n in chosen or out[self.parents[n]])
        return out


def kind_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """A form is MARKED only, as some pages stand in one as a whole; html, body and articles aren't marked by names."""
    if tag in ASIDE and tag != "form" or any(k == "hidden" for k, _ in attrs):
        return HIDDEN
    if tag == "form":
        return MARKED
    if tag in ("html", "body") or tag in ARTICLE:
        return PLAIN
    named = any(v and k in ("class", "id", "role") and any(map(ASIDE_NAME.fullmatch, v.split())) for k, v in attrs)
    return MARKED if named else PLAIN


class Lines(HTMLParser):
    """Collects a page's lines from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.in_link = False
        self.link_chars = 0
        #: Text of the line that an inline aside interrupts.
        self.before_aside: list[str] = []
        self.open: list[Open] = []
        #: How often each tag is open, and where heads are.
        self.count: Counter[str] = Counter()
        self.heads: list[int] = []
        self.asides = 0
        self.marks, self.regions = Tree(), Tree()

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers aren't used

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1] if self.open else OUTSIDE
            self.lines.append(Line(text, self.tags, top.hidden, top.mark, top.region, top.within, 2 * self.link_chars > len(text)))
        self.parts, self.tags, self.link_chars = [], 0, 0

    def push(self, tag: str, kind: int) -> None:
        top, at = (self.open[-1] if self.open else OUTSIDE), len(self.open)
        self.open.append(Open(
            tag, kind, at + 1 if tag in BLOCK else top.inline, top.hidden or kind == HIDDEN,
            self.marks.add(top.mark) if kind == MARKED else top.mark, self.regions.add(top.region, tag in ARTICLE) if tag in REGION else top.region,
            top.within | {tag} if tag in TEXTUAL and tag not in top.within else top.within,
        ))
        self.count[tag] += 1
        self.asides += kind != PLAIN
        if tag == "head":
            self.heads.append(at)

    def pop(self, at: int) -> None:
        for x in self.open[at:]:
            self.asides -= x.kind != PLAIN
            self.count[x.tag] -= 1
        del self.open[at:]
        while self.heads and self.heads[-1] >= at:
            self.heads.pop()

    def end_head(self, at: int) -> None:
        """What isn't of a head ends it, as </head> may be left out."""
        self.flush()
        self.pop(at)
        if not self.asides:
            self.parts, self.before_aside = self.before_aside, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "body" or tag not in HEAD:
            at = self.heads[0] if self.heads else None
            if at is not None and (tag == "body" or at == len(self.open) - 1):
                self.end_head(at)
        self.in_link |= tag == "a"
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCK:
            ends = CLOSES.get(tag, {"p"})
            at = self.inline()
            if at and self.open[at - 1].tag in ends:
                self.end_inline(at)
            self.flush()
            while self.open and self.open[-1].tag in ends:
                self.pop(len(self.open) - 1)
        elif tag in ("td", "th"):
            self.parts.append(" ")
        kind = kind_of(tag, attrs)
        if tag in BLOCK or kind != PLAIN:
            if kind != PLAIN and tag not in BLOCK:
                self.flush_inline()
            self.push(tag, kind)

    def inline(self) -> int:
        """Where the inline elements begin that are open within the innermost block."""
        return self.open[-1].inline if self.open else 0

    def end_inline(self, at: int) -> None:
        """The end of their block ends inline elements too: the line goes on with what stood before an aside."""
        before = self.asides
        self.pop(at)
        if before and not self.asides:
            self.parts, self.before_aside = self.before_aside, []

    def finish(self) -> None:
        """The end of the page, or of a block around an aside that holds blocks: what stood before it is a line."""
        self.flush()
        if self.before_aside and not self.asides:
            self.parts, self.before_aside = self.before_aside, []
            self.flush()

    def flush_inline(self) -> None:
        """An inline element that isn't content: the line goes on after it, without its text."""
        if not self.asides:
            self.before_aside, self.parts = self.parts, []

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag), None) if self.count[tag] else None
        if tag in BLOCK:
            if at is not None and (first := self.inline()) > at:
                self.end_inline(first)
            self.flush()
        if tag == "a":
            self.in_link = False
        if at is None:
            return
        before = self.asides
        self.pop(at)
        if before and not self.asides:
            if tag in BLOCK:
                self.finish()
            else:
                self.parts, self.before_aside = [*self.before_aside, " "], []

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].tag == "head" and data.strip():
            self.end_head(len(self.open) - 1)
        if self.open and self.open[-1].tag in ("script", "style"):
            return  # code is no line; its ratio would set the threshold
        self.parts.append(data)
        if self.in_link:
            self.link_chars += len(data.strip())


def smoothed(ratios: list[float]) -> list[float]:
    """Ratios averaged with Gaussian weights over the lines around; at the ends over those there are."""
    weights = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / (2 * SIGMA * SIGMA))
    middle = slice(RADIUS, RADIUS + len(ratios))
    return (np.convolve(ratios, weights)[middle] / np.convolve(np.ones(len(ratios)), weights)[middle]).tolist()


def threshold(values: list[float], rounds: int = 20) -> float:
    """Halfway between the means of two clusters, found by two-means from the extremes."""
    low, high = min(values), max(values)
    for _ in range(rounds):
        cut = (low + high) / 2
        below, above = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not above:
            return low
        now = sum(below) / len(below), sum(above) / len(above)
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def usable_lines(lines: list[Line], high: list[int], marks: Tree) -> list[int]:
    """Lines that aren't aside. A mark on what holds most of the high lines, and of their text, is one of a wrapper and
    doesn't count."""
    high = [i for i in high if not lines[i].hidden]
    chars: Counter[int] = Counter()
    for i in high:
        chars[lines[i].mark] += len(lines[i].text)
    total = sum(chars.values())
    chars_in, count_in = marks.summed(chars), marks.summed(Counter(lines[i].mark for i in high))
    aside = marks.below({n for n in range(1, len(chars_in)) if not (2 * chars_in[n] > total and 2 * count_in[n] > len(high))})
    return [i for i, x in enumerate(lines) if not x.hidden and not aside[x.mark]]


def joined(lines: list[Line], usable: list[int], inside: set[int], tagged: bool) -> set[int]:
    """Lines around the region that belong to it: paragraphs and headings up to the next line of links, with what lies
    between them, unless an article's tags bound the region; those between several articles; and the h1 before it, with
    what follows that isn't links."""
    first, last = min(inside), max(inside)
    before, after = [i for i in usable if i < first][::-1], [i for i in usable if i > last]
    between = [i for i in usable if first < i < last and i not in inside]
    out = {i for i in between if not lines[i].linked and lines[i].within & (PARAGRAPHS | HEADINGS)}
    if not tagged:
        for side, ends in ((before, PARAGRAPHS | HEADINGS), (after, PARAGRAPHS)):
            run = list(itertools.takewhile(lambda i: not lines[i].linked, side))
            out.update(run[: max((k + 1 for k, i in enumerate(run) if lines[i].within & ends), default=0)])
    if not any("h1" in lines[i].within for i in inside | out):
        title = next((i for i in before if "h1" in lines[i].within and not lines[i].linked), None)
        if title is not None:
            out.update(i for i in before if i >= title and not lines[i].linked)
    return out


def main_lines(lines: list[Line], marks: Tree, regions: Tree) -> list[Line]:
    """The lines of the content region, in page order."""
    if not lines:
        return []
    ratios = [len(x.text) / max(1, x.tags) for x in lines]
    articles = [regions.articles[x.region] for x in lines]
    values = [v * (BONUS if a else 1) for v, a in zip(smoothed(ratios), articles, strict=True)]
    cut = threshold(values)
    usable = usable_lines(lines, [i for i in range(len(lines)) if values[i] >= cut], marks)
    if not usable:
        return []
    # Links that only the lines around lift over the threshold are none of the content.
    content = [i for i in usable if values[i] >= cut and (ratios[i] >= cut or not lines[i].linked)]
    content = content or [i for i in usable if not lines[i].linked] or usable
    held = {articles[i] for i in content}
    tagged = 0 not in held
    if not tagged:
        # The innermost container of all of the content; it was opened after those that it stands in.
        in_it = regions.summed(Counter(lines[i].region for i in content))
        held = {max(n for n, count in enumerate(in_it) if count == len(content))}
    within = regions.below(held)
    inside = {i for i in usable if within[lines[i].region]}
    return [lines[i] for i in sorted(inside | joined(lines, usable, inside, tagged))]


def main_text(html: str) -> str:
    """The article's blocks joined by newlines; empty if there is none."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_inline(parser.inline())
    parser.flush()
    parser.pop(0)
    parser.finish()
    return "\n".join(x.text for x in main_lines(parser.lines, parser.marks, parser.regions))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every page. Null html counts as empty.

    Narrow: one row in, one row out, repeated rows too; each page is parsed whole, and only one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(h.as_py() or "").encode("utf-8", "replace").decode() for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars long")
