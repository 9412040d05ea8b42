"""Main text of web pages: streaming parser events, text-to-tag ratios of lines, Gaussian smoothing and threshold clustering.

The parser's events make lines: a line ends where a block begins or ends, and has its text, the number of its tags and how much of it stands in links. The ratios of text to tags, smoothed over neighbouring lines, are split by two-means clustering into content and the rest. The content lines choose the region: the article elements, if they hold half of the content in reach, else the main elements, else the innermost element, no part of a text itself, that holds all content lines. Of the region's lines those stay that are content, that stand between content lines, or that are no list of links (half of the text or more in links): a short heading or closing line stays, a row of links beside the text doesn't.

Tag rules help: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are never content. Elements of these names always go. Blocks that class, id or role name so go too, but for those that are also named as content, and for those that hold most of the page's text (if they aren't adverts or comments). Of inline elements go only buttons and the like, and those that a class calls adverts outright; the others are part of their line.

Defined results: a null or empty html, or one without text, gives an empty text; a page cut off in the middle is read as far as it goes; unknown declarations are taken as text; all lines of equal ratio are content; null urls and ids, repeated rows and other columns pass by; an empty table gives an empty result. Time and memory are linear in the page, however deep its elements.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by their part in a page, and words of class, id and role that mark what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul title".split())
ASIDE = frozenset("nav header footer aside form script style noscript template button select textarea iframe object svg canvas head title menu dialog".split())
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo".split())
COMMENT_WORDS = frozenset("comment comments disqus replies".split())
OTHER_WORDS = frozenset("banner cookie cookies consent gdpr notice notices alert menu nav navbar navigation sidebar footer header masthead share sharing social related breadcrumb breadcrumbs newsletter subscribe popup modal widget contentinfo complementary search dialog".split())
CONTENT_WORDS = frozenset("content main article post entry story body page wrapper container".split())
INLINE_ADVERTS = frozenset("ad ads advert advertisement sponsor sponsored".split())
CLOSES = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
#: Elements that are a part of a text, so never the region of it.
PARTS = frozenset("p li tr td th dt dd h1 h2 h3 h4 h5 h6 section pre table thead tbody tfoot caption ul ol dl blockquote figure figcaption details summary address center fieldset legend".split())
SIGMA = 1.0
_SPLIT = re.compile(r"[^a-z]+")
#: How an element was marked: not at all, as what isn't content if it doesn't hold most of the page, or for certain.
OPEN, SOFT, HARD = range(3)


class Lines(HTMLParser):
    """The lines of a page and the tree of its blocks, each with a number larger than its parent's."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # open elements: name, number of the block, and whether it mutes its text
        self.open: Counter = Counter()
        self.names, self.parents, self.marks = [""], [0], [OPEN]
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, length in links, block
        self.text: list[str] = []
        self.tags = self.linked = self.muted = 0

    def at(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def end_line(self) -> None:
        if self.text:
            if text := " ".join("".join(self.text).split()):
                self.lines.append((text, self.tags, self.linked, self.at()))
                self.tags = self.linked = 0
            self.text = []

    def mark(self, tag: str, attrs: list) -> int:
        if tag in ASIDE:
            return HARD
        if tag in ("html", "body", "article", "main"):
            return OPEN
        said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower()
        if not said:
            return OPEN
        if tag not in BLOCK:
            return OPEN if INLINE_ADVERTS.isdisjoint(said.split()) else HARD
        words = _SPLIT.split(said)
        if not (ADVERT_WORDS.isdisjoint(words) and COMMENT_WORDS.isdisjoint(words)):
            return HARD
        return SOFT if not OTHER_WORDS.isdisjoint(words) and CONTENT_WORDS.isdisjoint(words) else OPEN

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            self.handle_startendtag(tag, attrs)
            return
        self.tags += 1
        mark = self.mark(tag, attrs)
        if tag not in BLOCK:
            if tag in ("td", "th") or mark == HARD:
                self.text.append(" ")
            self.push(tag, self.at(), mark == HARD)
            return
        self.end_line()
        ends = CLOSES.get(tag, ("p",))
        while self.stack and self.innermost() in ends:
            self.pop()
        self.names.append(tag)
        self.parents.append(self.at())
        self.marks.append(mark)
        self.push(tag, len(self.names) - 1, False)

    def innermost(self) -> str:
        """The last open element, inline ones left out up to a few."""
        return next((name for name, _, _ in reversed(self.stack[-8:]) if name in BLOCK), "")

    def push(self, tag: str, number: int, mutes: bool) -> None:
        self.stack.append((tag, number, mutes))
        self.open[tag] += 1
        self.muted += mutes

    def pop(self) -> str:
        tag, _, mutes = self.stack.pop()
        self.open[tag] -= 1
        self.muted -= mutes
        return tag

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
        else:
            self.text.append(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
        if self.open[tag]:
            while tag in BLOCK or self.stack[-1][0] not in BLOCK:  # an inline end tag closes no block
                if self.pop() == tag:
                    break
        if tag in ("td", "th"):
            self.text.append(" ")

    def handle_data(self, data):
        if self.muted:
            return
        self.text.append(data)
        if self.open["a"]:
            self.linked += len(data)


def lines_of(html: str) -> Lines:
    for text in (html, html.replace("<!", "&lt;!")):
        parser = Lines()
        try:
            parser.feed(text)
            parser.close()
            break
        except AssertionError:  # a declaration that the parser doesn't know
            continue
    parser.end_line()
    return parser


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing within three sigma, with weights that add up to one at the ends too."""
    r = max(1, int(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(x, k)[r : r + len(x)] / np.convolve(np.ones(len(x)), k)[r : r + len(x)]


def threshold(x: np.ndarray) -> float:
    """The middle of two means."""
    low, high = float(x.min()), float(x.max())
    for _ in range(20):
        upper = x >= (low + high) / 2
        new = (float(x[~upper].mean()) if (~upper).any() else low, float(x[upper].mean()))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def clusters(ratio: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Which lines are content; links: the share of a line that stands in links. A line of links is no content for its neighbours' sake."""
    level = smooth(ratio)
    least = threshold(level) - 1e-9
    return (level >= least) & ((links < 0.5) | (ratio >= least))


def _summed(own: np.ndarray, parents: list) -> np.ndarray:
    """For each element the sum of its own and its descendants' values."""
    total = own.tolist()
    for n in range(len(parents) - 1, 0, -1):
        total[parents[n]] += total[n]
    return np.array(total)


def _inside(chosen: np.ndarray, parents: list) -> np.ndarray:
    """The elements that are chosen or stand in a chosen one."""
    found = chosen.tolist()
    for n in range(1, len(parents)):
        found[n] = found[n] or found[parents[n]]
    return np.array(found)


def main_text(html: str | None, cluster=clusters) -> str:
    page = lines_of(html or "")
    if not page.lines:
        return ""
    texts, tags, linked, at = zip(*page.lines)
    names, parents, marks, at = np.array(page.names), page.parents, np.array(page.marks), np.array(at)
    size = np.array([len(t) for t in texts])
    weigh = lambda x: _summed(np.bincount(at, weights=x, minlength=len(names)), parents)
    apart = _inside(marks == HARD, parents)
    held = weigh(size * ~apart[at])
    apart = _inside((marks == HARD) | (marks == SOFT) & (2 * held <= held[0]), parents)
    own = ~apart[at]
    if not own.any():
        return ""
    ratio = np.array([s / max(1, n) for s, n in zip(size, tags)])
    links = np.array(linked) / size
    content = cluster(ratio, links) & own
    if not content.any():
        content = own
    good, total = weigh(size * content), float((size * content).sum())
    region = None
    for kind in ("article", "main"):
        chosen = _inside((names == kind) & ~apart, parents)
        if chosen.any() and 2 * (size * content)[chosen[at]].sum() >= total:
            region = chosen
            break
    if region is None:
        whole = np.flatnonzero((good >= total - 0.5) & ~np.isin(names, list(PARTS)))
        region = _inside(np.arange(len(names)) == whole[-1], parents)
    use = own & region[at]
    places = np.flatnonzero(use & content)
    if len(places):
        between = np.zeros(len(at), bool)
        between[places[0] : places[-1] + 1] = True
        use &= content | between | (links < 0.5)
    return "\n".join(t for t, keep in zip(texts, use) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
