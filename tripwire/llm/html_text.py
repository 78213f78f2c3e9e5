"""Main text of web pages by the line-block distribution."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.shared import read

# Element names and the words in class, id or role that mark what is not the article.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead
tr ul""".split())
LEFT_OUT = frozenset("head nav footer aside form button dialog menu header".split())
ROOTS = frozenset("article main".split())
CONTAINERS = frozenset("article div main section td center blockquote".split())
ENDS_EARLY = frozenset("p li dt dd tr td th option".split())
VOID = frozenset("br hr img input meta link source wbr col area base embed param track".split())
LABELS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|popup|modal|overlay|sidebars?|side-bar|"
    r"menus?|nav\w*|breadcrumbs?|footer|site-header|page-header|masthead|topbar|comments?|commentlist|disqus|replies|respond|related|"
    r"recommend\w*|share|sharing|social\w*|newsletter|subscribe|signup|login|search|pagination|pager|widget\w*|skip-link|toolbar)(?:$|[\s_-])",
    re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|object|canvas|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)", re.IGNORECASE | re.DOTALL)
_ATTR = re.compile(r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)


def _marks_out(tag: str, attrs: str, in_root: bool) -> bool:
    if tag in LEFT_OUT and not (tag == "header" and in_root):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if LABELS.search(value) and tag not in ROOTS or tag == "article" and re.search(r"\bcomment", value, re.IGNORECASE):
                return True
        elif name == "role" and value.lower() in ROLES or name == "hidden":
            return True
        elif name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


def page_lines(page: str) -> tuple[list[tuple[str, int, bool, int]], list[int]]:
    """Lines (text, length that counts, in an article, container) of a page, one for each block, and the parent of each container.

    Left-out blocks are blank lines. Linked text does not count towards a line's length. Containers are numbered in
    page order, 0 is the page; an end tag closes the innermost open container of its name, with
    all in it, and counts for nothing where none is open.
    """
    lines: list[tuple[str, int, bool, int]] = []
    parents, opened = [0], [(0, "")]
    counts = dict.fromkeys(CONTAINERS, 0)
    parts: list[str] = []
    linked = roots = links = depth = at = 0
    skip = None

    def end_line():
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            lines.append((text, max(0, len(text) - linked), roots > 0, opened[-1][0]))
        parts, linked = [], 0

    def take(text: str):
        nonlocal linked
        if text and skip is None:
            parts.append(text)
            if links:
                linked += len(text.strip())

    for m in _MARKUP.finditer(page):
        take(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, closes = tag.lower(), bool(m["end"])
        if skip is not None:
            if tag == skip and skip not in VOID:
                depth += -1 if closes else 0 if skip in ENDS_EARLY else 1
            early = skip in ENDS_EARLY and (tag == skip or (skip == "p" and tag in BLOCKS) or (closes and tag in ("ul", "ol", "dl", "table")))
            if tag in BLOCKS:
                lines.append(("", 0, False, opened[-1][0]))
            if depth > 0 and not early:
                continue
            own, skip = tag == skip, None
            if closes and own:
                continue
        if tag in BLOCKS:
            end_line()
        elif tag in ("br", "td", "th"):
            take(" ")
        if tag == "a":
            links = 0 if closes else 1
        if closes:
            if tag in CONTAINERS and counts[tag]:
                end_line()
                name = ""
                while name != tag:
                    name = opened.pop()[1]
                    counts[name] -= 1
                roots = sum(counts[x] for x in ROOTS)
            continue
        if tag not in VOID and _marks_out(tag, m["attrs"], roots > 0):
            end_line()
            lines.append(("", 0, False, opened[-1][0]))
            skip, depth = tag, 1
        elif tag in CONTAINERS:
            parents.append(opened[-1][0])
            opened.append((len(parents) - 1, tag))
            counts[tag] += 1
            roots += tag in ROOTS
    take(page[at:])
    end_line()
    return lines, parents


def _story(lengths: list[int], holders: list[int], parents: list[int], share: float) -> tuple[int, list[bool]]:
    """The innermost container that holds ``share`` of all length, and which containers are in it."""
    held = [0] * len(parents)
    for n, c in zip(lengths, holders):
        held[c] += n
    for c in range(len(parents) - 1, 0, -1):
        held[parents[c]] += held[c]
    story = 0
    for c in range(1, len(parents)):  # a container comes after its parent; two that are apart can't both hold most
        if parents[c] == story and held[c] >= share * held[0]:
            story = c
    inside = [False] * len(parents)
    inside[story] = True
    for c in range(story + 1, len(parents)):
        inside[c] = inside[parents[c]]
    return story, inside


def surges(lengths: list[int], window: int, surge: int, dive: int) -> list[tuple[int, int]]:
    """Stretches (first line, line after the last) between surge and dive points of the sums over ``window`` lines.

    A stretch begins at the first line with text of the first window that reaches the surge, and ends
    where the window from a line on falls under the dive. Both are limits for long pages;
    where the largest sum is under twice the surge, half and an eighth of it take their place.
    """
    n = len(lengths)
    sums = [sum(lengths[:window])]
    for i in range(n):
        sums.append(sums[-1] - lengths[i] + (lengths[i + window] if i + window < n else 0))
    peak = max(sums)
    up, down = min(surge, -(-peak // 2)), min(dive, -(-peak // 8))
    found, start = [], None
    for i in range(n + 1):
        if start is None and sums[i] >= up > 0:
            start = i
            while lengths[start] == 0:
                start += 1
        elif start is not None and i > start and (sums[i] < down or i == n):
            found.append((start, i))
            start = None
    return found


def main_text(page: str | None, window: int = 3, surge: int = 80, dive: int = 20, share: float = 0.6) -> str:
    """Main text of a page: its blocks joined by newlines; empty if there is none.

    The lengths of the lines without links are summed over sliding windows of ``window`` lines (lines in an
    article or main element count twice); text between surge and dive points (see ``surges``) is a stretch. The innermost
    container that holds ``share`` or more of the stretches' length is the story: its stretches
    and its short lines with unlinked text are kept. Where no container but the page itself
    does, the stretches are kept, with the lines of their own containers that adjoin them without a
    blank line; those under a fifth of the longest are boiler-plate.

    Tags that are never closed, closed twice or cut off by the end are read as far as they go; pages of any
    length are read whole, once from front to back.
    """
    if not page:
        return ""
    lines, parents = page_lines(page)
    texts, holders = [x[0] for x in lines], [x[3] for x in lines]
    lengths = [n * (2 if marked else 1) for _, n, marked, _ in lines]
    stretches = surges(lengths, window, surge, dive)
    kept = [False] * len(lines)
    for a, b in stretches:
        kept[a:b] = [True] * (b - a)
    story, inside = _story([x[1] if k else 0 for x, k in zip(lines, kept)], holders, parents, share)
    if story:
        kept = [inside[c] and (k or n > 0) for k, n, c in zip(kept, lengths, holders)]
    else:
        sizes = [sum(lengths[a:b]) for a, b in stretches]
        kept = [False] * len(lines)
        for (a, b), n in zip(stretches, sizes):
            if 5 * n >= max(sizes):
                while a > 0 and lengths[a - 1] and holders[a - 1] == holders[a]:
                    a -= 1
                while b < len(lines) and lengths[b] and holders[b] == holders[b - 1]:
                    b += 1
                kept[a:b] = [True] * (b - a)
    return "\n".join(t for t, k in zip(texts, kept) if k and t)


def extract(page: Column, **options) -> Column:
    """Main text of a html column, row by row on whole pages; empty for null."""
    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array((main_text(p.as_py(), **options) for p in pages), pa.string())

    return of(page)


def extract_pages(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; repeated rows and null ids stay, other columns go."""
    return pages.select("page_id", "url", extract(F.col("html"), **options).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: main text of every page."""
    return extract_pages(read(spark, sf_dir, "pages"))
