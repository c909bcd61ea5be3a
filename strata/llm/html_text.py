"""Main text of HTML pages by text-to-tag ratio (op 9).

Standard-library parser events become lines: one a block element, with its text and the number of tags met in it.
The ratio of characters to tags of each line is smoothed with a Gaussian over neighbouring lines; lines at or
above the threshold (the standard deviation of the smoothed ratios) cluster into content. The content region is
the smallest element that holds all the clustered text, and all its blocks are returned, short ones too. Where no line
outside of ``article`` and ``main`` elements reaches the threshold by itself (only through its neighbours), it is what
holds all of their part: the smallest element inside one of them, or else all of them. Elements that are never content
are left out wherever they stand:
menus, headers (but for headings in an article), footers, sidebars, scripts, styles, and elements whose role names
them as navigation or the like. So are forms, and elements whose class or id names them as adverts, notices, comments
or the like, unless one holds most of the page's text and no ``article`` or ``main`` has text outside it.

White space inside a block (line breaks too) becomes one space; blocks are trimmed and joined by one line feed;
character references are decoded. Unclosed and unmatched tags are accepted, a marked section that HTML doesn't know is a
comment, and the work grows with a page's length however deep its tags are nested. A null or empty page, one without
text and one without tags that is blank have an empty text; a page without any block is one block. Repeated rows
give equal rows. Other columns pass through ``main_text_column``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches

SIGMA, MOST = 1.0, 0.6
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup td th time tt u var wbr".split())
NEVER = frozenset("head title nav header footer aside script style noscript template iframe object svg button "
                  "select textarea menu dialog".split())
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|aside|nav\w*|menu\w*|breadcrumbs?|"
    r"footer|header|masthead|comments?|comment-\w+|disqus|replies|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"newsletter|subscribe|subscription|signup|share|sharing|social|related|recommend\w*|widget|pagination|toolbar|"
    r"login|search)(?=$|[\s_-])", re.IGNORECASE)
#: Parts of class names that tell of other elements (no-sidebar), or of an article's own head.
_TELLS = re.compile(r"(?:^|(?<=\s))(?:(?:no|with|without|has|have)[-_]\S+|(?:article|post|entry|story|content)[-_]header)(?=$|\s)",
                    re.IGNORECASE)
_HEADING = re.compile(r"h[1-6]$")
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}


class Lines(HTMLParser):
    """Collects lines (text, tags, element) and elements (name, parent, whether it is never content, whether its name
    says that it isn't, and the element that decides for it instead of its parent, or -1)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []  # name and number of the element
        self.open: Counter[str] = Counter()  # open elements by name
        self.blocks: list[int] = []  # places in the stack of those that aren't inline
        self.stories: list[int] = []  # numbers of the open article and main elements
        self.elements: list[tuple[str, int, bool, bool, int]] = []
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.stack[-1][1] if self.stack else -1))
            self.tags = 0
        self.parts = []

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # a keyword that the parser doesn't know
            return self.parse_bogus_comment(i)

    def cut(self, k: int) -> None:
        """Close the elements from place ``k`` of the stack on."""
        for name, _ in self.stack[k:]:
            self.open[name] -= 1
            if name in ("article", "main"):
                self.stories.pop()
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()
        del self.stack[k:]

    def never(self, tag: str, attrs) -> bool:
        if tag in NEVER:
            return True
        for key, value in attrs:
            if key == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "form"):
                return True
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                return True
            if key == "style" and value and re.search(r"display\s*:\s*none", value):
                return True
        return tag == "article" and any(k in ("class", "id") and v and "comment" in v.lower() for k, v in attrs)

    def named(self, tag: str, attrs) -> bool:
        return tag == "form" or tag not in ("body", "html", "article", "main") and any(
            v and k in ("class", "id") and _NAMED.search(v) and _NAMED.search(_TELLS.sub("", v)) for k, v in attrs)

    def barred(self) -> list[bool]:
        """Whether each element is left out."""
        names = [x[0] for x in self.elements]
        up = [x[1] for x in self.elements]

        def spread(own: list[bool]) -> list[bool]:
            out: list[bool] = []
            for x, mine in zip(self.elements, own, strict=True):
                out.append(out[x[4]] if x[4] >= 0 else mine or (x[1] >= 0 and out[x[1]]))
            return out

        never = spread([x[2] for x in self.elements])
        if not any(x[3] for x in self.elements):
            return never
        total, size = 0, [0] * len(names)
        for text, _, at in self.lines:
            if at < 0 or not never[at]:
                total += len(text)
                if at >= 0:
                    size[at] += len(text)
        for e in range(len(names) - 1, -1, -1):
            if up[e] >= 0:
                size[up[e]] += size[e]
        # text in the outermost article and main elements, and what of it each element holds
        inside: list[bool] = []
        story = [0] * len(names)
        for e, name in enumerate(names):
            above = up[e] >= 0 and inside[up[e]]
            inside.append(above or name in ("article", "main"))
            story[e] = size[e] if inside[e] and not above and not never[e] else 0
        every = sum(story)
        for e in range(len(names) - 1, -1, -1):
            if up[e] >= 0:
                story[up[e]] += story[e]
        return spread([x[2] or x[3] and not (size[e] >= MOST * total and (inside[e] or story[e] == every))
                       for e, x in enumerate(self.elements)])

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if self.blocks and self.stack[self.blocks[-1]][0] in _CLOSES.get(tag, ()):  # the block that this one closes
            self.cut(self.blocks[-1])
        up = self.stack[-1] if self.stack else ("", -1)
        decides = -1
        if _HEADING.match(tag) and up[0] == "header":
            decides = self.stories[-1] if self.stories else -1
        self.elements.append((tag, up[1], self.never(tag, attrs), self.named(tag, attrs), decides))
        if tag in ("article", "main"):
            self.stories.append(len(self.elements) - 1)
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.open[tag] += 1
        self.stack.append((tag, len(self.elements) - 1))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        elif tag in ("td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if self.open[tag]:
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                k -= 1
            self.cut(k)

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][0] in ("script", "style", "noscript", "template")):
            self.parts.append(data)


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines, weights renormalised at the ends."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach:reach + len(ratio)] / weight


def main_text(html) -> str:
    """The main text of one page."""
    if not isinstance(html, str) or not html.strip():
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.flush()
    lines, names = page.lines, [x[0] for x in page.elements]
    up, barred = [x[1] for x in page.elements], page.barred()
    may = [k for k, x in enumerate(lines) if x[2] < 0 or not barred[x[2]]]
    if not may:
        return ""
    ratio = np.zeros(len(lines))
    ratio[may] = [len(lines[k][0]) / max(1, lines[k][1]) for k in may]
    level = smoothed(ratio)
    chosen = [k for k in may if level[k] >= level.std()] or may
    story = [False] * len(names)  # inside an article or main element
    for e, name in enumerate(names):
        story[e] = name in ("article", "main") or (up[e] >= 0 and story[up[e]])
    told = [k for k in chosen if lines[k][2] >= 0 and story[lines[k][2]]]
    if any(ratio[k] >= level.std() for k in set(chosen) - set(told)):
        told = []
    chosen = told or chosen
    # chosen lines by element; the smallest element with all of them is the region
    count = [0] * len(names)
    for k in chosen:
        if lines[k][2] >= 0:
            count[lines[k][2]] += 1
    for e in range(len(names) - 1, -1, -1):
        if up[e] >= 0:
            count[up[e]] += count[e]
    region = max((e for e, n in enumerate(count) if n == len(chosen) and names[e] not in INLINE
                  and names[e] not in _CLOSES and not _HEADING.match(names[e])), default=-1)
    if told and (region < 0 or not story[region]):
        return "\n".join(lines[k][0] for k in may if lines[k][2] >= 0 and story[lines[k][2]])
    inside = [False] * len(names)
    for e in range(len(names)):
        inside[e] = e == region or (up[e] >= 0 and inside[up[e]])
    return "\n".join(lines[k][0] for k in may if region < 0 or (lines[k][2] >= 0 and inside[lines[k][2]]))


def main_text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in pages], index=pages.index, dtype=object)

    return run(html)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) for every row."""
    bounded_batches(pages.sparkSession)
    got = pages.select("page_id", "url", main_text_column(F.col("html")).alias("text"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
