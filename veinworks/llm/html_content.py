"""Main text of HTML pages by text-to-tag ratios.

Parser events are turned, in one pass, into lines: the text between block tags,
with the number of tags in it. Text-to-tag ratios are smoothed with a Gaussian
over neighbouring lines and cut in two clusters; lines of the higher cluster
mark the content. Parts whose tag, role, class or id says that they are something
else are left out, unless they hold nearly all of the marked text: then the name
was misread. The region that holds the marked lines gives the text: sibling
articles that together hold most of the marked text, else the innermost container
of nearly all of it. All of it takes time in proportion to the page.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from veinworks.llm.base import map_arrow, query, table, texts

# The roles of HTML elements.
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math head title iframe object audio video canvas select option button textarea datalist".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
# Roles and words in classes and ids of parts that are not the article.
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar sidebars menu "
    "menus nav navbar navigation breadcrumb breadcrumbs footer masthead banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus respond replies "
    "discussion share sharing social related recommended recommendations widget widgets login pagination pager toolbar "
    "skip hidden".split()
)
PAGE_NAMES = frozenset("header topbar toolbar site".split())  # only outside an article
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# Names of parts whose articles are not the article of the page.
SECONDARY = frozenset(
    "comment comments commentlist disqus respond replies discussion related recommended recommendations teaser teasers "
    "promo promotion sponsored advertisement".split()
)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

SIGMA, REACH = 1.0, 3
APART = 0.3  # of the higher cluster's mean, which the lower one's must not reach
MOST = 0.5  # of the selected text that articles must hold to be the region
SHARE = 0.98  # of the selected text that a container must hold to be entered
MISREAD = 0.9  # of the selected text in a part that its name would leave out


@dataclass
class Line:
    text: str
    tags: int
    path: tuple[int, ...]  # open containers, outermost first
    asides: tuple[int, ...]  # open parts that are something else, by number
    heading: bool
    aside: bool = False


class Lines(HTMLParser):
    """Collects the lines of a page from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[str] = []
        self.kinds: list[tuple[int, int]] = []  # of open elements: container or -1, aside or -1
        self.count = Counter()  # open elements by tag
        self.silent = self.headings = 0
        self.path: list[int] = []
        self.asides: list[int] = []  # open ones
        self.firm: list[int] = []  # of all asides: 1, or 2 where an article in it does not count
        self.certain: list[bool] = []  # of all asides: whatever they hold
        self.containers: list[str] = []
        self.text: list[str] = []
        self.tags = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append(Line(text, self.tags, tuple(self.path), tuple(self.asides), self.headings > 0))
            self.tags = 0
        self.text = []

    def _pop(self, depth: int) -> None:
        if any(tag in BLOCKS for tag in self.open[depth:]):
            self._flush()
        for tag, (container, aside) in zip(reversed(self.open[depth:]), reversed(self.kinds[depth:]), strict=True):
            self.count[tag] -= 1
            self.silent -= tag in SILENT
            self.headings -= tag in HEADINGS
            if container >= 0:
                self.path.pop()
            if aside >= 0 and self.asides and self.asides[-1] == aside:
                self.asides.pop()
        del self.open[depth:], self.kinds[depth:]

    def _is_aside(self, tag: str, attrs: dict[str, str]) -> int:
        if tag in ASIDE:
            return 2
        in_article = self.count["article"] + self.count["main"] > 0
        if tag == "header" and not in_article:
            return 1
        names = [w.lower() for w in WORDS.findall(attrs.get("class", "") + " " + attrs.get("id", ""))]
        if tag == "article" and names and names[0] in SECONDARY:
            return 2
        if tag in ("html", "body", "article", "main"):
            return 0
        if SECONDARY.intersection(names):
            return 2
        if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
            return 1
        if UNSEEN.search(attrs.get("style", "")):
            return 1
        return int(not NAMES.isdisjoint(names) or not in_article and not PAGE_NAMES.isdisjoint(names))

    @staticmethod
    def _says_so(attrs: dict[str, str]) -> bool:
        """Whether a part is called something else by a whole name, its role or its style, not by a word of a longer name."""
        if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
            return True
        whole = {*attrs.get("class", "").lower().split(), attrs.get("id", "").lower()}
        return not NAMES.isdisjoint(whole) or not SECONDARY.isdisjoint(whole) or bool(UNSEEN.search(attrs.get("style", "")))

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:  # the tag counts for the line that it starts
            self._flush()
            self._imply_end(("p",))
        self.tags += 1
        if tag in VOID:
            self.text.append(" " if tag == "br" else "")
            return
        if tag in CLOSED_BY:
            self._imply_end(CLOSED_BY[tag])
        found = {k: v or "" for k, v in attrs}
        # A wrapper named after one of its parts is not that part; within an article it is.
        if tag in ("article", "main") and not self.count["article"]:
            self.asides = [k for k in self.asides if self.firm[k] == 2]
        container = aside = -1
        firm = self._is_aside(tag, found)
        if tag in CONTAINERS:
            container = len(self.containers)
            self.containers.append("main" if found.get("role") == "main" else tag)
            self.path.append(container)
        if firm:
            aside = len(self.firm)
            self.firm.append(firm)
            self.certain.append(tag != "form" and (tag in ASIDE or tag == "header" or self._says_so(found)))
            self.asides.append(aside)
        self.open.append(tag)
        self.kinds.append((container, aside))
        self.count[tag] += 1
        self.silent += tag in SILENT
        self.headings += tag in HEADINGS

    def _imply_end(self, tags: tuple[str, ...]) -> None:
        """Close an open element of these, unless a container or list stands between."""
        if not any(self.count[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth]
            if tag in tags:
                self._pop(depth)
                return
            if tag in CONTAINERS or tag in ("ul", "ol", "dl", "table", "blockquote") or tag in ASIDE:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.count[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth] == tag:
                self._pop(depth)
                return

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)

    def finish(self) -> None:
        self.close()
        self._flush()


def selected(lines: list[Line]) -> np.ndarray:
    """Which lines lie in the higher of two clusters of smoothed text-to-tag ratios; all, where the two are close."""
    ratio = np.array([len(x.text) / max(1, x.tags) for x in lines])
    at = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(at**2) / (2 * SIGMA**2))
    smooth = np.convolve(ratio, kernel, "full")[REACH : REACH + len(ratio)]
    smooth /= np.convolve(np.ones(len(ratio)), kernel, "full")[REACH : REACH + len(ratio)]
    low, high = smooth.min(), smooth.max()
    if high - low < 1e-9:
        return np.ones(len(lines), bool)
    for _ in range(50):  # two means; settles in a few rounds
        upper = smooth >= (low + high) / 2
        new = smooth[~upper].mean(), smooth[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return smooth >= (low + high) / 2 if low < APART * high else np.ones(len(lines), bool)


def region(lines: list[Line], marked: np.ndarray, containers: list[str]) -> list[Line]:
    """The lines of the part of the page that holds the marked ones."""
    weight = np.array([len(x.text) * (m and not x.aside) for x, m in zip(lines, marked, strict=True)])
    held, depth = {}, {}
    for x, w in zip(lines, weight.tolist(), strict=True):
        for d, c in enumerate(x.path):
            held[c] = held.get(c, 0) + w
            depth[c] = d
    total, inside = weight.sum(), None
    for tag in ("article", "main"):
        siblings = {}  # outermost ones with marked text, by the container around them
        for x in lines:
            at = next((d for d, c in enumerate(x.path) if containers[c] == tag), None)
            if at is not None and held[x.path[at]] > 0:
                siblings.setdefault(x.path[:at], set()).add(x.path[at])
        best = max(siblings.values(), key=lambda cs: sum(held[c] for c in cs), default=set())
        if sum(held[c] for c in best) > MOST * total:
            return [x for x in lines if not x.aside and not best.isdisjoint(x.path)]
    for c in sorted(held, key=depth.get):
        if held[c] >= SHARE * total and held[c] > 0:
            inside = c
    rows = [(x, m) for x, m in zip(lines, marked, strict=True) if not x.aside and (inside is None or inside in x.path)]
    at = [k for k, (_, m) in enumerate(rows) if m]
    if not at:
        return [x for x, _ in rows]
    first = at[0]
    while first and rows[first - 1][0].heading:
        first -= 1
    return [x for x, _ in rows[first : at[-1] + 1]]


def main_text(html: str) -> str:
    """Blocks of the article in page order, an empty line between them; empty if there is none."""
    parser = Lines()
    parser.feed(html)
    parser.finish()
    leave_out(parser)
    lines = [x for x in parser.lines if not x.aside]
    return "\n\n".join(x.text for x in region(lines, selected(lines), parser.containers)) if lines else ""


def leave_out(parser: Lines) -> None:
    """Mark the lines of parts that are something else.

    A form, or a part that only a word of a longer name calls so, stays in when
    it holds nearly all of the text that the ratios select among the lines that
    nothing surer rules out: the page would have no text without it.
    """
    open_lines = [x for x in parser.lines if not any(parser.certain[k] for k in x.asides)]
    held, total = Counter(), 0
    for x, m in zip(open_lines, selected(open_lines) if open_lines else (), strict=True):
        total += len(x.text) * m
        for k in x.asides:
            held[k] += len(x.text) * m
    misread = {k for k, n in held.items() if total and n >= MISREAD * total}
    for x in parser.lines:
        x.aside = any(k not in misread for k in x.asides)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and ``n_chars``.

    A null html counts as empty and gives an empty text. Columns of the names
    made here are replaced. Every page is parsed whole.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    rows = pages.select(*kept, F.col(html_col).alias("_html"))
    schema = StructType([*rows.schema.fields[:-1], *StructType.fromDDL("text string, n_chars long").fields])

    def run(batches):
        for batch in batches:
            found = [main_text(html) for html in texts(batch.column(len(kept)))]
            columns = [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], schema.fieldNames())

    return map_arrow(rows, run, schema)


@query("op3_html_extraction")
def op3(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
