"""Main text of web pages by the distribution of text over blocks of lines.

1. Markup is stripped to lines, one for every block of the page (paragraph, heading, list
   item, table row ...), in page order. What can never be main text carries none: menus,
   headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments,
   told by element, role, or the words of class and id. Where a container (``div``,
   ``section`` ...) begins or ends, an empty line stands. Where a page has an ``article``
   with text (else a ``main``), lines outside it carry none either.
2. A line counts with its text length; lines that are mostly links count nothing. The
   lengths are summed over sliding windows of ``WINDOW`` lines.
3. Where the sum leaves zero is a surge point, where it falls back a dive point. A surge
   counts if the sums behind it reach ``PEAK`` of the page's highest (inside a marked
   article every one does). All text between the first surge and the last dive is kept.

Tags, quotes, ends of elements and character references may be missing or cut; a comment,
script or style without an end reaches to the end of the page. References are decoded once.

Edge cases: a null or empty html, or one without text, gives an empty text; repeated rows
and ids give a row each; null ids and urls stay. Long pages are read whole. Other columns
are not read, so their names may clash with results.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
PEAK = 0.2
RESULT = "page_id bigint, url string, text string, n_chars bigint"

TOKEN = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)            # comment
      | <[!?][^>]*>                      # doctype, processing instruction
      | <(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
      | <(?P<end2>/)?(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*)>   # quotes that never close
      | </?[A-Za-z][^<>]*\Z              # a tag cut off by the end of the page""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""(?:^|\s|["'])(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
SPACE = re.compile(r"\s+")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# Elements of HTML by what they do to text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body div section article main header footer aside nav form fieldset table ul ol dl blockquote figure details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr caption pre address figcaption summary hgroup center hr tbody thead tfoot html head".split())
CELLS = frozenset("td th br option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = RAW | frozenset(
    "head nav footer aside form button select noscript template svg math object audio video canvas dialog menu datalist applet map".split()
)
#: A start tag of these ends an open element of the same set (``</li>`` and its like may be left out).
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
# Words of class and id names that mark what is not main text ...
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit adsbygoogle dfp banner sponsor sponsored
    sponsors promo promos promotion nav navi navbar navigation subnav topnav sidenav menu menus submenu breadcrumb breadcrumbs pagination pager
    sidebar sidebars aside rail widget widgets footer footnav copyright colophon header masthead topbar notice notices cookie cookies consent gdpr
    alert alerts popup modal overlay lightbox newsletter subscribe subscription signup login register search share sharing sharebar social comment
    comments commentlist commentform disqus respond replies reply reactions related recommended recommendations toolbar skiplink paywall disclaimer legal""".split()
)
#: ... those of them that may also name a part of the article or the layout, and the words that say so.
LAYOUT = frozenset("header banner masthead sidebar rail".split())
ARTICLE = frozenset("article content entry post story main".split())
ABSENT = frozenset("no has with without hide".split())


def marked(value: str) -> bool:
    """Whether the words of a class or id attribute say that an element is not main text."""
    names = [[w.lower() for w in NAME_WORD.findall(name)] for name in value.split()]
    for i, name in enumerate(names):
        own = any(w in ARTICLE for w in name)
        others = any(w in ARTICLE and not MARKS & set(n) for j, n in enumerate(names) if j != i for w in n)
        for before, word in zip([None, *name], name):
            if word not in MARKS or before in ABSENT:
                continue
            if word in LAYOUT and (others or (own and word in ("header", "banner", "masthead"))):
                continue
            return True
    return False


@dataclass
class Element:
    name: str
    skip: bool  # not main text
    zone: str | None  # "article" or "main" that it stands in
    link: bool


def excluded(name: str, rest: str, zone: str | None) -> bool:
    """Whether an element is told to be no main text."""
    if name in NEVER or (name == "header" and zone is None):
        return True
    if name in ("html", "body", "main") or not rest:
        return False
    for key, *values in ATTRIBUTE.findall(rest):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or (key == "role" and value.lower() in ROLES) or (key in ("class", "id") and marked(value)):
            return True
    return False


@dataclass
class Line:
    text: str
    linked: int  # characters of it that stand in links
    zone: str | None


def strip(page: str) -> list[Line]:
    """The lines of a page; what is not main text is gone, and containers are parted by empty lines."""
    lines: list[Line] = []
    here: list[str] = []
    linked = 0
    stack = [Element("", False, None, False)]

    def close_line(gap: bool) -> None:
        nonlocal linked
        text = SPACE.sub(" ", references.unescape("".join(here))).strip()
        here.clear()
        if text:
            lines.append(Line(text, linked, stack[-1].zone))
        linked = 0
        if gap:
            lines.append(Line("", 0, stack[-1].zone))

    def pop(to: int) -> None:
        gap = any(e.name in CONTAINERS and not e.skip for e in stack[to:])
        if gap or any(e.name in BLOCKS for e in stack[to:]):
            close_line(gap)
        del stack[to:]

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].skip:
            here.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        if token["end"] or token["end2"]:
            if name in CELLS:
                add(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    pop(i)
                    break
            else:
                if name == "p":
                    close_line(False)
            continue
        top = stack[-1]
        if name in RAW:
            found = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = found.end() if found else end
            continue
        if name in CELLS:
            add(" ")
        if name in BLOCKS:
            # a block ends an open paragraph, and whatever inline elements that paragraph left open
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in CONTAINERS or stack[i].name in ITEMS:
                    break
                if stack[i].name == "p" or stack[i].name in HEADINGS and name in HEADINGS:
                    pop(i)
                    break
        if name in ITEMS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ITEMS[name]:
                    pop(i)
                    break
                if stack[i].name in CONTAINERS:
                    break
        top = stack[-1]
        rest = token["rest"] or token["rest2"] or ""
        skip = top.skip or excluded(name, rest, top.zone)
        if name in BLOCKS and not top.skip:
            close_line(name in CONTAINERS and not skip)
        if name in VOID or rest.endswith("/") and name in ("svg", "math", "path"):
            continue
        zone = name if name == "article" else top.zone or ("main" if name == "main" or re.search(r"role\s*=\s*[\"']?main\b", rest) else None)
        link = (top.link or name == "a") and name not in BLOCKS
        if name in BLOCKS or name in ITEMS or skip != top.skip or name == "a":
            stack.append(Element(name, skip, None if skip else zone, link))
    close_line(False)
    return lines


def weights(lines: list[Line]) -> np.ndarray:
    """Text length of every line; none of lines that are mostly links."""
    return np.array([0 if 2 * x.linked > len(x.text) else len(x.text) for x in lines], dtype=np.int64)


def window_sums(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sum of the ``window`` lines from each line on, and before the first line."""
    ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(window - 1, np.int64), lengths, np.zeros(window, np.int64)]))])
    return ends[window:] - ends[:-window]


def surges(lengths: np.ndarray, peak: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """First and last line with text between every surge point whose sums reach ``peak`` of the highest and its dive point."""
    sums = window_sums(lengths, window)
    alive = np.concatenate([[False], sums > 0, [False]])
    up, down = np.flatnonzero(alive[1:] & ~alive[:-1]), np.flatnonzero(alive[:-1] & ~alive[1:])
    # the window of sums[i] covers lines i - (window - 1) .. i
    return [(int(u), int(d) - window) for u, d in zip(up, down) if sums[u:d].max() >= peak * sums.max()]


def main_text(page: str) -> str:
    """The main text of a page, its blocks joined by line breaks."""
    lines = strip(page)
    peak = PEAK
    for zone in ("article", "main"):
        if any(x.zone == zone and x.text for x in lines):
            lines = [x if x.zone == zone else Line("", 0, None) for x in lines]
            peak = 0.0
            break
    lengths = weights(lines)
    if peak == 0.0 or not lengths.any():
        lengths = np.array([len(x.text) for x in lines], dtype=np.int64) if peak == 0.0 else lengths
    found = surges(lengths, peak) if lengths.any() else []
    if not found:
        return ""
    return "\n".join(x.text for x in lines[found[0][0] : found[-1][1] + 1] if x.text)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (page_id, url, html)."""

    def run(batches):
        for batch in batches:
            ids, urls, htmls = batch.columns
            texts = [main_text(h.as_py() or "") for h in htmls]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, RESULT)
