"""Main text of web pages by tag-path ratios.

The text nodes of a page are grouped by the path of tags from the root.  For
each path the text and the punctuation per node are taken, without the share
that is in links; both are smoothed over the nodes in page order, fused, and
compared with a threshold.  Paths above it are content, and so are the other
paths within the nearest element that holds them all: titles and short paragraphs.
When the heaviest path is in an article or main element, only paths in such elements count.
Elements that are never part of an article (by tag, role, class or id) are left out first,
unless they wrap the page: such a form or "has-sidebar" is judged by its ratios.

Tags may be left open and pages cut off; comments, scripts and tags that don't
end reach to the end of the page.  A null page has the empty text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quadloom.llm.common import by_batch, column, prepare

# How far a node's neighbours count, and the threshold as a share of the mean fused ratio.
SMOOTH, THRESHOLD = 1.0, 0.25

# Names of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = "script style noscript template iframe svg math object title textarea canvas audio video".split()
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = set("nav footer aside form button select option dialog menu head fieldset".split())
MARKED = {"article", "main"}
SECTIONS = set("html body main article section div".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# Words in classes and ids of what surrounds an article.
AROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banners?|sponsor\w*|promo\w*|sidebar|side|menus?|nav\w*|breadcrumbs?|foot(?:er)?|header|masthead|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w+|comments?|comment\w*list|repl(?:y|ies)|respond|disqus|discussion|"
    r"share|sharing|social|related|recommended|widgets?|login|signup|search|pagination|pager|skip|toolbar|copyright)(?:$|[\s_-])",
    re.I,
)

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)>|<[a-zA-Z/!?][^>]*(?:>|$)", re.S
)
_HIDDEN_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|$)", re.I) for t in HIDDEN}
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters in links) of the blocks in page order, without what is never content."""
    out: list[tuple[tuple[str, ...], str, int, int]] = []
    stack: list[str] = []  # open elements that aren't inline; what a path is made of
    within = [-1]  # for the page and each of them, the nearest of the named ones
    named: list[list] = []  # elements whose names say that they are never content: tag, depth, the named one around, articles in it
    text: list[str] = []
    linked, link = 0, False
    at = 0

    def end() -> None:
        nonlocal linked
        if text:
            if joined := " ".join(html.unescape("".join(text)).split()):
                out.append((tuple(stack), joined, min(linked, len(joined)), within[-1]))
            text.clear()
            linked = 0

    def close(k: int) -> None:
        nonlocal link
        end()
        del stack[k:], within[k + 1 :]
        link = False

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start() if m else n]
        if piece:
            text.append(piece)
            linked += len(piece.strip()) if link else 0
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link = False
            elif tag not in INLINE and tag in (names := [s.partition(".")[0] for s in stack]):
                close(len(names) - 1 - names[::-1].index(tag))
            continue
        if tag in _HIDDEN_END:
            if not m[3].endswith("/") or tag not in ("svg", "math"):
                over = _HIDDEN_END[tag].search(page, at)
                at = over.end() if over else n
            continue
        if tag == "br":
            text.append(" ")
        if tag in VOID:
            if tag == "hr":
                end()
            continue
        if tag in INLINE:
            link = link or tag == "a"
            continue
        names = [s.partition(".")[0] for s in stack]
        if "p" in names:  # a block ends an open paragraph
            close(len(names) - 1 - names[::-1].index("p"))
        elif tag in CLOSES and names and names[-1] in CLOSES[tag]:
            close(len(names) - 1)
        end()
        given = {k.lower(): (a or b or c) for k, a, b, c in _NAMES.findall(m[3])} if m[3] else {}
        label = " ".join(filter(None, (given.get("class"), given.get("id"))))
        around = tag in NEVER or given.get("role", "").lower() in ROLES or tag == "header" and "article" not in names
        around = around or bool(label) and tag not in ("html", "body", "article", "main") and bool(AROUND.search(label))
        stack.append(f"{tag}.{label}" if label else tag)
        if tag in MARKED:
            last, i = max((k for k, t in enumerate(names) if t in MARKED), default=-1), within[-1]
            while i >= 0 and named[i][1] > last:
                named[i][3] += 1
                i = named[i][2]
        if around:
            named.append([tag, len(stack), within[-1], 0])
        within.append(len(named) - 1 if around else within[-1])
    end()
    if not named:
        return [b[:3] for b in out]
    kept = wrappers(out, named)
    return [b[:3] for b in out if b[3] < 0 or kept[b[3]]]


def wrappers(found: list[tuple[tuple[str, ...], str, int, int]], named: list[list]) -> list[bool]:
    """Which of the named elements are, with all that are around them, wrappers of the page whose names don't count.

    A wrapper holds several blocks with most of the text that isn't in links, or the one article,
    and the page has no other article that is content.
    """
    tags, depths, parents, articles = zip(*named)
    free, total, parts = [0] * len(named), [0] * len(named), [0] * len(named)
    some: list[tuple[str, ...]] = [()] * len(named)  # the path of a block in each
    for path, text, linked, i in found:
        if i >= 0:
            free[i] += len(text) - linked
            total[i] += len(text)
            parts[i] += 1
            some[i] = path
    for i in range(len(named) - 1, -1, -1):
        if (k := parents[i]) >= 0:
            free[k], total[k], parts[k], some[k] = free[k] + free[i], total[k] + total[i], parts[k] + parts[i], some[k] or some[i]
    half = sum(len(t) - k for _, t, k, _ in found) / 2
    half_total = sum(len(t) for _, t, _, _ in found) / 2
    # a footer or nav is a wrapper when it was left open, not on a page of links
    out = {i for i, t in enumerate(tags) if free[i] > half and parts[i] > 1 and (t not in ("nav", "footer") or total[i] > half_total)}
    one = {i for i, n in enumerate(articles) if n == 1 and free[i]} - out
    if out or one:
        content = at_least([f[:3] for f in found])[0]
        marks = {p: [k + 1 for k, s in enumerate(p) if s.partition(".")[0] in MARKED] for p in {f[0] for f in found}}
        for path, i in {(f[0], f[3]) for f in found if f[0] in content and marks[f[0]]} if one else ():
            while i >= 0:
                if i in one and marks[path][-1] > depths[i]:
                    out.add(i)
                i = parents[i]
        others = {f[0] for f in found if f[3] < 0 and marks[f[0]] and f[2] < len(f[1])}
        size = sum(len(t) - k for p, t, k, i in found if i < 0 and p in others)

        def rival(i: int) -> bool:
            apart = [p for p in others if any(p[:k] != some[i][:k] or k > depths[i] for k in marks[p])]
            return size >= THRESHOLD * free[i] or any(p in content or tags[i] in ("nav", "footer") for p in apart)

        out = {i for i in out if not rival(i)}
    kept: list[bool] = []
    for i, k in enumerate(parents):
        kept.append(i in out and (k < 0 or kept[k]))
    if any(f[3] < 0 or kept[f[3]] for f in found):
        return kept
    # nothing would be left
    kept = []
    for t, k in zip(tags, parents):
        kept.append(t not in ("nav", "footer") and (k < 0 or kept[k]))
    return kept


def ratios(found: list[tuple[tuple[str, ...], str, int]]) -> dict[tuple[str, ...], float]:
    """For each path its fused ratio: text per node times punctuation per node, both smoothed."""
    paths = [f[0] for f in found]
    totals: dict[tuple[str, ...], list[float]] = {}
    for path, text, linked in found:
        t = totals.setdefault(path, [0, 0, 0])
        t[0] += 1
        t[1] += len(text) - linked
        t[2] += sum(unicodedata.category(c)[0] == "P" for c in set(text) if not c.isalnum()) if linked < len(text) else 0
    length = np.array([totals[p][1] / totals[p][0] for p in paths])
    points = np.array([1 + totals[p][2] / totals[p][0] for p in paths])
    reach = int(3 * SMOOTH)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SMOOTH) ** 2)

    def smooth(x: np.ndarray) -> np.ndarray:
        padded = np.pad(x, reach, mode="edge")
        return np.convolve(padded, kernel / kernel.sum(), mode="valid")

    fused = np.sqrt(length * smooth(length)) * np.sqrt(points * smooth(points))
    out: dict[tuple[str, ...], float] = {}
    for p, f in zip(paths, fused):
        out[p] = max(out.get(p, 0.0), float(f))
    return out


def at_least(found: list[tuple[tuple[str, ...], str, int]]) -> tuple[set, dict, dict]:
    """The paths at or above the threshold; the fused ratio and the characters outside links of every path."""
    score = ratios(found)
    weight = {p: sum(len(t) - k for _, t, k in g) for p, g in groupby(sorted(found), key=lambda f: f[0])}
    mean = sum(score[p] * weight[p] for p in score) / max(1, sum(weight.values()))
    return {p for p, s in score.items() if s >= THRESHOLD * mean and s > 0}, score, weight


def main_text(page: str | None) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    content, score, weight = at_least(found)
    if not content:
        return ""
    # the nearest element that holds all content; of the articles only, when the best path is in one
    mark = {p: next((k + 1 for k, s in enumerate(p) if s.partition(".")[0] in MARKED), 0) for p in score}
    if mark[max(content, key=lambda p: (weight[p], score[p]))]:
        score = {p: s for p, s in score.items() if mark[p]}
        holder = commonprefix([p[: mark[p]] for p in content if mark[p]])
    else:
        holder = commonprefix(list(content))
        holder = holder[: max((k + 1 for k, s in enumerate(holder) if s.partition(".")[0] in SECTIONS), default=0)]
    inside = {p for p in score if p[: len(holder)] == holder}
    return " ".join(t for p, t, k in found if p in inside and (p in content or 2 * k <= len(t)))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``id_column``, ``url_column``, text and n_chars for every row."""
    prepare(pages.sparkSession)

    def work(batch):
        texts = [main_text(x) for x in column(batch, "html").to_pylist()]
        return {
            id_column: column(batch, "id"),
            url_column: column(batch, "url"),
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        }

    given = pages.selectExpr(f"`{id_column}` as id", f"cast(`{url_column}` as string) as url", f"cast(`{html_column}` as string) as html")
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(by_batch(work), f"`{id_column}` {kind}, `{url_column}` string, text string, n_chars long")
