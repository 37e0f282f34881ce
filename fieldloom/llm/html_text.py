"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import slices

#: Lines of a sliding window; weighed text length at which a window surges, and below which it dives.
WINDOW, SURGE, DIVE = 3, 80, 15
#: What a character weighs in an element marked as boilerplate, in one marked so in part, and outside a marked article.
LOW, PART, OUTSIDE = 1 / 50, 1 / 3, 1 / 20
#: The place of the page itself.
PAGE = -1
#: A stretch of text that weighs less than this share of the heaviest one is left out.
SHARE = 0.05

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=[ \t\r\n\f]*+(?:\"[^\"]*+\"|'[^']*+'|))*+)>")
_NAMED = re.compile(r"</?[a-zA-Z]")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")

_RAW = {"script", "style", "textarea", "iframe", "noscript", "xmp", "title", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "head", "select", "button", "svg", "menu", "dialog", "object", "canvas", "audio", "video", "map"}
_MAIN = {"article", "main"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
_CONTAINERS = {"article", "center", "div", "form", "main", "section", "td"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class, id and role attributes that mark what is not the article.
_BOILERPLATE = {
    "ad", "ads", "adbox", "advert", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "outbrain", "pagination", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social",
    "sponsor", "sponsored", "subscribe", "taboola", "toolbar", "topbar", "widget",
}

_MARKS = {"class", "id", "role", "aria-label"}
_HAVING = {"has", "have", "having", "no", "not", "with", "without"}
_OWN = {"article", "content", "entry", "page", "post", "section", "story"}
#: Words that beside a word of boilerplate say the same: "related-posts", "comment-list", "ad-slot".
_PIECES = {"area", "articles", "bar", "block", "body", "box", "button", "buttons", "container", "footer", "form", "header", "icons", "inner", "item", "items", "links", "list", "posts", "section", "site", "slot", "stories", "top", "unit", "wrap", "wrapper"}


def _marks(name: str, attributes: str) -> float:
    """What a character of an element weighs by its attributes: nothing if it is hidden, little if it is boilerplate.

    A token of a class, id, role or label counts by the share of its words that name boilerplate: "cookie
    notice" says it in full, "related-work" in part. One that says what the element has ("has-sidebar"), how
    it is laid out ("sidebar-layout") or that it is the article's own header ("article-header") says nothing;
    nor do ids of headings, which repeat their text.
    """
    weight = 1.0
    if not attributes or attributes.isspace():
        return weight
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSEEN.search(value):
            return 0.0
        if key not in _MARKS or key == "id" and name in _HEADINGS:
            continue
        for token in value.split():
            words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())
            found = [w for w in words if w in _BOILERPLATE]
            if found and words[0] not in _HAVING and "layout" not in words and not (set(found) == {"header"} and _OWN.intersection(words)):
                weight = min(weight, LOW if len(found) == len(words) or _PIECES.intersection(words) else PART)
    return weight


def _tokens(html: str) -> list[tuple]:
    """("text", text), ("open", name, attributes), ("close", name); raw elements and comments are gone. Linear in the page.

    A tag whose quotes never end shows that quotes cannot be relied on: from there on tags end at the next ">".
    """
    out: list[tuple] = []
    at = start = 0
    tag, lost = _TAG, set()  # lost: raw elements and ">" that do not occur again

    def find(what: str, begin: int) -> int:
        end = -1 if what in lost else html.find(what, begin)
        if end < 0:
            lost.add(what)
        return end

    while (at := html.find("<", at)) >= 0:
        follows = html[at + 1 : at + 2]
        if follows in ("!", "?"):
            if html.startswith("<!--", at):
                end = find("-->", at + 4)
                end = len(html) if end < 0 else end + 3
            else:
                end = find(">", at) + 1
            if not end:
                at += 1
                continue
            if at > start:
                out.append(("text", html[start:at]))
            at = start = end
            continue
        m = None
        if _NAMED.match(html, at) and find(">", at) >= 0:
            m = tag.match(html, at)
            if not m:
                tag = _PLAIN_TAG
                m = tag.match(html, at)
        if not m:
            at += 1
            continue
        if at > start:
            out.append(("text", html[start:at]))
        at = start = m.end()
        name = m[2].lower()
        if not m[1] and name in _RAW:
            end = None if name in lost else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            if end or name in ("script", "style"):
                at = start = end.end() if end else len(html)
                continue
            lost.add(name)
        out.append(("close", name) if m[1] else ("open", name, m[3]))
    if start < len(html):
        out.append(("text", html[start:]))
    return out


def _ends(tokens: list[tuple]) -> dict[int, int]:
    """Index of the end tag of each start tag that has one."""
    open_: dict[str, list[int]] = {}
    ends = {}
    for i, t in enumerate(tokens):
        if t[0] == "open" and t[1] not in _VOID:
            open_.setdefault(t[1], []).append(i)
        elif t[0] == "close" and open_.get(t[1]):
            ends[open_[t[1]].pop()] = i
    return ends


def _weights(tokens: list[tuple], ends: dict[int, int]) -> tuple[dict[int, tuple[int, float]], list[int]]:
    """Last token and weight of each element that weighs less than others, and where the article or main region starts.

    The region is any main, and the longest article unless it lies in boilerplate and has less text than the
    rest of the page: then it is a card that leads elsewhere. What surrounds the region weighs as much as other
    elements, whatever its marks say.
    """
    sizes = list(accumulate((len(t[1].strip()) if t[0] == "text" else 0 for t in tokens), initial=0))
    stops = [k for k, t in enumerate(tokens) if t[0] == "open" and t[1] in (*_MAIN, "h1")] + [len(tokens)]
    light: dict[int, tuple[int, float]] = {}
    starts, articles = [], []
    for i, t in enumerate(tokens):
        if t[0] != "open":
            continue
        name = t[1]
        if name == "main":
            starts.append(i)
        elif name == "article":
            articles.append((sizes[ends.get(i, len(tokens))] - sizes[i], -i))
        elif name not in _VOID and name not in ("html", "body"):
            weight = _marks(name, t[2])
            if name in _DROPPED:
                weight = min(weight, LOW)
            if weight < 1 and i in ends:
                light[i] = ends[i], weight
            elif name in _DROPPED:
                light[i] = stops[bisect_right(stops, i)] - 1, weight
    if articles:
        most, at = max(articles)
        free, until, inside = sizes[-1], -1, False
        for i, (end, _) in light.items():
            inside |= i < -at <= end
            if end > until:
                free -= sizes[end + 1] - sizes[max(i, until + 1)]
                until = end
        if not inside or most >= free:
            starts.append(-at)
    starts.sort()
    return {i: x for i, x in light.items() if bisect_right(starts, i) == bisect_right(starts, x[0])}, starts


def lines(html: str) -> tuple[list[tuple[str, float, float, int, int]], dict[int, int]]:
    """A page's blocks in order (text, weighed length, weight of a character, container, article), and the containers' parents.

    White space inside a block is one space; text of links weighs nothing in a block that is mostly links.
    Marks weigh (see `_marks`, `_weights`), and where the page marks its article, what is outside weighs
    OUTSIDE. WINDOW empty lines part a container, and an element of less weight, from what surrounds it, so
    that windows dive there. An article without an end tag goes on to the end of what surrounds it.
    Containers and articles are the places of their start tags, or PAGE; a container that holds no
    block of its own is a block.
    """
    tokens = _tokens(html)
    ends = _ends(tokens)
    light, starts = _weights(tokens, ends)
    blocks = list(accumulate((t[0] == "open" and t[1] not in _INLINE and t[1] not in _VOID for t in tokens), initial=0))
    around: list[tuple[int, int]] = [(len(tokens), PAGE)]  # end and place of the containers
    heavy: list[tuple[int, float]] = [(len(tokens), 1.0)]  # end and weight of the elements
    parents: dict[int, int] = {}
    out: list[tuple[str, int, float, int, int]] = []
    parts: list[str] = []
    links = anchored = heading = 0
    head_until = -1
    mains: list[tuple[int, int]] = []  # end and place of the articles
    gap = [("", 0, 1.0, PAGE, PAGE)] * WINDOW

    def close() -> None:
        nonlocal anchored
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            counted = max(0, len(text) - anchored) if anchored * 2 < len(text) else 0
            out.append((text, len(text) if mains else counted, heavy[-1][1], around[-1][1], mains[-1][1] if mains else PAGE))
        parts.clear()
        anchored = 0

    for i, t in enumerate(tokens):
        if t[0] == "text":
            if i > head_until or heading:
                parts.append(t[1])
                if links:
                    anchored += len(t[1].strip())
            continue
        name = t[1]
        if name not in _INLINE:
            close()
        elif name in ("br", "img"):
            parts.append(" ")
        while i >= around[-1][0] and len(around) > 1:
            around.pop()
            out.extend(gap)
        while i >= heavy[-1][0] and len(heavy) > 1:
            close()
            heavy.pop()
            out.extend(gap)
        if t[0] == "open":
            if name == "a":
                links += 1
            elif name in _MAIN:
                mains.append((ends.get(i, mains[-1][0] if mains else len(tokens)), i))
            own_header = name == "header" and mains and i in ends and _marks(name, t[2]) == 1
            if own_header:
                head_until, heading = ends[i], 0
            elif name in _HEADINGS:
                heading = 1
            if name in _VOID or name in ("html", "body"):
                continue
            if i in light and not own_header and (i > head_until or name not in _DROPPED or _marks(name, t[2]) < 1):
                close()
                out.extend(gap)
                links = anchored = 0
                heavy.append((min(light[i][0], heavy[-1][0]), min(light[i][1], heavy[-1][1])))
            if name in _CONTAINERS and i in ends and blocks[ends[i]] > blocks[i + 1]:
                parents[i] = around[-1][1]
                around.append((min(ends[i], around[-1][0]), i))
                out.extend(gap)
        else:
            if name == "a":
                links = max(0, links - 1)
            elif name in _HEADINGS:
                heading = 0
            while mains and i >= mains[-1][0]:
                mains.pop()
                out.extend(gap)
    close()
    marked = any(main != PAGE and w == 1 for *_, w, _, main in out)
    weighed = ((text, n, w * (OUTSIDE if marked and main == PAGE else 1), where, main) for text, n, w, where, main in out)
    return [(text, n * w, w, where, main) for text, n, w, where, main in weighed], parents


def _carried(page: list[tuple], parents: dict[int, int], kept: set[int], order: range, root: bool) -> None:
    """Adds to `kept` the lines, in this order, of containers and articles that a kept line before lies in, and inside them.

    Such a line must weigh as much a character. `root`: the page itself counts as a container. Each container
    is entered and left once.
    """
    path, given, depth = [PAGE], [2.0], {PAGE: 0}  # the open containers, and what a character must weigh in each
    for i in order:
        _, n, w, where, main = page[i]
        if not n:
            continue
        chain, at = [], where
        while at not in depth:
            chain.append(at)
            at = parents[at]
        while path[-1] != at:
            del depth[path.pop()]
            given.pop()
        for at in reversed(chain):
            given.append(given[-1] if path[-1] != PAGE else 2.0)
            depth[at] = len(path)
            path.append(at)
        if i not in kept and (root or where != PAGE) and w >= max(given[-1], 2 * LOW):
            kept.add(i)
        if i in kept:
            given[-1] = min(given[-1], w)
            if main != PAGE and main in depth and given[level := depth[main]] > w:
                given[level:] = [min(g, w) for g in given[level:]]


def main_text(html: str | None, surge: float = SURGE, dive: float = DIVE) -> str:
    """Text between the surge and dive points of a page's line-block distribution, joined by newlines.

    A window is WINDOW lines from a line on. Text starts at a line whose window weighs more than `surge` and
    goes on until one that starts with an empty line weighs less than `dive`; a page may surge more than once.
    Stretches that weigh less than SHARE of the heaviest are left out, and lines that weigh nothing. Other
    lines of a container or article that has given text belong to it if they weigh as much a character: what
    was taken out between them ends nothing. Of a page without a surge the heaviest stretch
    of lines is kept. Null or empty html, and a page without any text, gives "". Work is linear in the page.
    """
    page, parents = lines(html) if html else ([], {})
    size = [n for _, n, *_ in page] + [0.0] * WINDOW
    totals = list(accumulate(size, initial=0.0))
    stretches: list[list[int]] = []
    inside = False
    for i, (_, n, *_) in enumerate(page):
        total = totals[i + WINDOW] - totals[i]
        if not inside and total > surge and n:
            inside = True
            stretches.append([])
        if inside and total < dive and not n:
            inside = False
        if inside and n:
            stretches[-1].append(i)
    if not stretches:
        run: list[int] = []
        for i in range(len(size)):
            if size[i]:
                run.append(i)
            elif run:
                stretches.append(run)
                run = []
        stretches = [max(stretches, key=lambda x: sum(size[i] for i in x))] if stretches else []
    mass = [sum(size[i] for i in x) for x in stretches]
    kept = {i for x, m in zip(stretches, mass, strict=True) if m >= SHARE * max(mass) for i in x}
    _carried(page, parents, kept, range(len(page)), True)
    _carried(page, parents, kept, range(len(page) - 1, -1, -1), False)
    return "\n".join(page[i][0] for i in sorted(kept))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page's whole html; no shuffle.

    Null or empty html gives an empty text. Pages of any length are read whole, in time linear in them; rows
    are read one after the other. Repeated rows are extracted each, null ids and urls stay null, extra columns
    are ignored, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")
