"""Main text of web pages: text-to-tag ratios of lines, smoothed and clustered.

``html.parser`` events are read as a stream. A line is the text between two block-level
tags; its text-to-tag ratio is its characters for each tag in it. The ratios, in page
order, are smoothed with a Gaussian kernel; lines whose smoothed ratio passes a share of
the ratios' standard deviation cluster as content. The content region is where their mass
lies: the article elements together, else main, if they hold most of it, else the smallest
element that holds all content lines. All lines of the region are kept, however short, and the
clusters outside it, apart from those inside elements that are not article text by their kind (navigation, forms,
scripts ...) or by a whole token of their class, id or role (advert, cookie-bar, comments
...). Where only a part of a token is such a word (has-sidebar, related-work), or the word
may name text (discussion, legal), the element is nominated and the ratios decide. What may
wrap a whole page (form, dialog, widget, overlay ...) is kept if most of the content mass
lies in it.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from ..session import ship_by_value
from .common import append_columns

ship_by_value(__name__)

SIGMA = 1.0
THRESHOLD = 0.5
_FEED = 1 << 16

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
# Never article text.
_DROP = frozenset(
    "script style noscript template head title nav footer aside button select option textarea input iframe object"
    " embed svg canvas audio video menu".split()
)
# Not article text, unless the page's text lies in it.
_WRAP_TAGS = frozenset("form fieldset label map dialog".split())
_WRAP_WORDS = frozenset("widget modal overlay popup".split())
_REGION = frozenset("article main section div td body html".split())
_CLOSED_BY_BLOCK = frozenset(["p"])
_SELF_NESTED = frozenset("li dt dd tr td th option".split())
_BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner sidebar side menu nav navbar"
    " navigation breadcrumb breadcrumbs footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices popup modal overlay"
    " alert share sharing social related recommended newsletter subscribe subscription signup login search pagination pager comment comments"
    " commentlist discussion disqus replies reply respond copyright legal disclaimer skip widget complementary contentinfo".split()
)
# Of these the words that article text is as often named by: alone they only nominate.
_TOPIC = frozenset("discussion legal header head notice notices alert side menu social".split())
# Reader comments by other names: one word of each kind in a token.
_READERS = frozenset("user users reader readers visitor visitors customer customers".split())
_OPINIONS = frozenset("remarks opinions feedback letters voices reviews reactions responses".split())
# Words of an id that never name a section of an article's text.
_NO_TOPIC = frozenset(
    "ad ads advert adverts advertisement sidebar nav navbar breadcrumb breadcrumbs footer masthead topbar toolbar popup modal pagination pager"
    " comment comments commentlist disqus respond".split()
)
# Words that add nothing to a name: comments-area, ad-slot, cookie-bar.
_FRAME = frozenset("area bar block body box buttons container count form icons inner item items label link links list outer panel row section slot text unit wrap wrapper".split())
_ARTICLE_NAMES = frozenset(["comment", "comments", "reply", "ad", "ads", "promo", "sponsored"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_KEEP, _GENTLE, _NOMINATE, _WRAP, _DROPPED = range(5)


def _grade(tag: str, attrs: list[tuple[str, str | None]], in_article: bool, in_main: bool) -> int:
    """What an element's kind, class, id and role say: ``_DROPPED`` if its kind or a whole
    class, id or role token names boilerplate, ``_NOMINATE`` if only a part of a token
    does (the ratios decide), ``_GENTLE`` if the word may as well name a part of the article,
    ``_WRAP`` if it may hold the whole page."""
    if tag in _DROP or tag == "header" and not (in_article or in_main):
        return _DROPPED
    grade = _WRAP if tag in _WRAP_TAGS else _KEEP
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return _DROPPED
        if name == "style" and value and _HIDDEN.search(value):
            return _DROPPED
        if name not in ("class", "id", "role") or not value or tag in ("html", "body", "main"):
            continue
        if name == "id" and tag in _HEADINGS:  # an anchor made from the heading's words
            continue
        known = _ARTICLE_NAMES if tag == "article" else _BOILERPLATE
        for token in value.split():
            parts = frozenset(_NAME.findall(_CAMEL.sub("-", token).lower()))
            named = parts & known
            if parts & _READERS and parts & _OPINIONS:
                return _DROPPED
            if not named:
                continue
            sure = named - _TOPIC if name != "id" or not in_article else named & _NO_TOPIC
            if name == "role" or sure and parts <= _BOILERPLATE | _FRAME:
                if tag == "article" or not sure or not sure <= _WRAP_WORDS:
                    return _DROPPED
                grade = max(grade, _WRAP)
                continue
            if tag != "article":
                grade = max(grade, _GENTLE if in_article and not sure else _NOMINATE)
    return grade


class _Lines(HTMLParser):
    """Collects ``(text, tags, link characters, dropped, innermost region, innermost
    nominee, h1)``; regions and nominees know their parents."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, int]] = [("", 0, False, -1)]  # tag, region number, dropped, nominee number
        self.regions = [(-1, "")]  # parent, tag
        self.nominees: list[tuple[int, int]] = []  # parent, grade
        self.lines: list[tuple[str, int, int, bool, int, int, bool]] = []
        self.text: list[str] = []
        self.tags = 0
        self.linked = 0
        self.in_link = False

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            tag, region, dropped, nominee = self.open[-1]
            self.lines.append((text, self.tags, self.linked, dropped, region, nominee, tag == "h1"))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCK:
            self.flush()
            self.in_link = False
            if tag in ("article", "main"):  # no navigation holds them: it was not closed
                navs = [i for i, o in enumerate(self.open) if o[0] == "nav"]
                if navs:
                    del self.open[navs[0] :]
            if self.open[-1][0] in _CLOSED_BY_BLOCK:
                self.open.pop()
            if tag in _SELF_NESTED and self.open[-1][0] == tag:
                self.open.pop()
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.in_link = True
        grade = _grade(tag, attrs, any(o[0] == "article" for o in self.open), any(o[0] == "main" for o in self.open))
        drop = grade == _DROPPED
        apart = drop or tag in _WRAP_TAGS
        if tag in _VOID or not (tag in _BLOCK or apart):
            return
        if apart and tag not in _BLOCK:
            self.flush()
        parent = self.open[-1]
        region = parent[1]
        if tag in _REGION:
            self.regions.append((region, tag))
            region = len(self.regions) - 1
        nominee = parent[3]
        if grade in (_GENTLE, _NOMINATE, _WRAP):
            self.nominees.append((nominee, grade))
            nominee = len(self.nominees) - 1
        self.open.append((tag, region, parent[2] or drop, nominee))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.in_link = False
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.flush()
                del self.open[i:]
                return
        if tag in _BLOCK:
            self.flush()

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.in_link:
            self.linked += len(data.strip())


def _smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(np.ceil(sigma)))
    kernel = np.exp(-np.arange(-r, r + 1) ** 2 / (2 * sigma * sigma))
    weight = np.convolve(np.ones(len(ratio)), kernel)[r : r + len(ratio)]
    return np.convolve(ratio, kernel)[r : r + len(ratio)] / weight


def _refused(p: _Lines, content: np.ndarray) -> list[bool]:
    """The nominees to drop: without a heading of the page or a line that passes as content
    and is not links; where the word may name text, only if they are mostly links; what may
    wrap a page, if no more than half of the content's mass lies in it."""
    holds = [False] * len(p.nominees)
    text_chars, link_chars, mass = [0] * len(p.nominees), [0] * len(p.nominees), [0] * len(p.nominees)
    whole = 0
    for (text, _, linked, _, _, n, h1), passes in zip(p.lines, content.tolist()):
        own = max(0, len(text) - linked) if passes else 0
        whole += own
        while n >= 0:
            mass[n] += own
            holds[n] = holds[n] or h1 or passes and linked < 0.7 * len(text)
            text_chars[n] += len(text)
            link_chars[n] += linked
            n = p.nominees[n][0]
    return [
        2 * m <= whole if g == _WRAP else not h and (g != _GENTLE or 2 * k >= t)
        for h, (_, g), t, k, m in zip(holds, p.nominees, text_chars, link_chars, mass)
    ]


def _region(p: _Lines, mass: dict[int, float], lines: dict[int, int]) -> tuple[set[int], bool]:
    """The regions that hold the content, and whether their elements name them so: all
    outermost articles, else mains, if together they hold most of the mass; else the
    smallest element that holds all content lines."""
    whole = mass[0]
    for tag in ("article", "main"):
        found = set()
        for r in sorted(r for r in mass if p.regions[r][1] == tag):
            up = p.regions[r][0]
            while up >= 0 and up not in found:
                up = p.regions[up][0]
            if up < 0:
                found.add(r)
        if sum(mass[r] for r in found) > 0.5 * whole:
            return found, True
    return {max(r for r in mass if lines[r] == lines[0])}, False


def main_text(html: str, sigma: float = SIGMA, threshold: float = THRESHOLD) -> str:
    """The page's article text: blocks joined by one space; empty if there is none."""
    p = _Lines()
    for a in range(0, len(html), _FEED):
        p.feed(html[a : a + _FEED])
    p.close()
    p.flush()
    live = np.array([not x[3] for x in p.lines], bool)
    if not live.any():
        return ""
    chars = np.array([len(x[0]) - min(x[2], len(x[0])) for x in p.lines], float)
    own = chars / np.array([max(1, x[1]) for x in p.lines])
    smooth = _smoothed(own, sigma)
    passes = smooth > min(threshold * smooth.std(), smooth[live].max() * 0.5)
    if p.nominees:
        refused = _refused(p, passes & live)
        for i, x in enumerate(p.lines):
            n = x[5]
            while n >= 0 and not refused[n]:
                n = p.nominees[n][0]
            live[i] &= n < 0
        if not live.any():
            return ""
    content = live & passes
    if not content.any():
        content = live & (smooth == smooth[live].max())

    mass: dict[int, float] = {}
    lines: dict[int, int] = {}
    for i in np.flatnonzero(content):
        r = p.lines[i][4]
        while r >= 0:
            mass[r] = mass.get(r, 0.0) + chars[i] + 1e-6
            lines[r] = lines.get(r, 0) + 1
            r = p.regions[r][0]
    best, named = _region(p, mass, lines)
    inside = []
    for x in p.lines:
        r = x[4]
        while r >= 0 and r not in best:
            r = p.regions[r][0]
        inside.append(r >= 0)
    # outside the region: clusters with a line that passes by its own ratio
    outside = content & ~np.array(inside, bool)
    if outside.any():
        limit = min(threshold * own.std(), own[live].max() * 0.5)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], outside.astype(np.int8), [0]])))
        for a, b in zip(edges[::2], edges[1::2]):
            outside[a:b] = own[a:b].max() > limit
    keep = [bool(live[i] and (inside[i] and (named or content[i] or x[2] < 0.7 * len(x[0])) or outside[i])) for i, x in enumerate(p.lines)]
    if not any(k and x[6] for k, x in zip(keep, p.lines)):  # the headline may stand before the region
        before = [i for i, x in enumerate(p.lines[: keep.index(True)]) if x[6] and live[i] and x[2] < 0.7 * len(x[0])] if any(keep) else []
        if before:
            keep[before[-1]] = True
    return " ".join(x[0] for k, x in zip(keep, p.lines) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars`` (code points); columns with those names are
    replaced. NULL or empty html, and pages without article text, give an empty text;
    repeated rows give equal results; pages are read whole, in pieces."""

    def run(html: pa.Array) -> list[pa.Array]:
        texts = [main_text(h) if h else "" for h in html.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return append_columns(pages, [html_col], [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], run)
