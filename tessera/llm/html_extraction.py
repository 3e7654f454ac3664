"""HTML extraction by differencing pages with the nearest URLs.

1. Every page is cut into lines, one for each visible block of text, and each line gets a hash and what the markup says
   of it: inside the main element, inside a part that never belongs to the text, neither, or doubtful (inside the main
   element, but under a name that partly sounds like a menu or an advert).
2. Pages are sorted by host, path and rest of the URL, so the pages of one large host lie in many tasks. Each page is
   paired with the `reach` pages before and after it in its host. Copies and near copies (_COPY of the text that markup
   leaves) say nothing of the template and aren't compared.
3. The lines of a pair are aligned by longest common subsequence. Lines that pairs of at least `support` different
   pages of a host share are its template, which goes from all pages of the host: a story that two pages share isn't one.
4. Template lines are deleted, whatever the markup says of them, but for those inside the article, since passages of
   articles recur too. An exact check by markup follows for lines that no neighbour has (reader comments, adverts
   dealt to one page): what is in menus, headers, footers, forms and the like goes. A page never loses all its text to the template.

Sorted pages get their place in the whole order, and are dealt out in blocks of `block` pages with the `reach` before
them, so the result doesn't depend on how the table is cut into partitions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, picked, stored, trimmed

# Names of HTML elements, roles and words in class names.
_RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video"}
_APART = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset"}
_MAIN = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "meter", "output", "progress", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "promo", "promotion", "sponsor", "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "comment", "comments", "disqus", "respond", "reply", "replies", "footer", "header", "masthead", "related", "recommended", "share", "sharing", "social", "widget", "widgets", "pagination", "pager", "toolbar", "skip"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
#: Words that say nothing beside others in a name.
_NEUTRAL = {"area", "bar", "block", "body", "bottom", "box", "container", "inner", "item", "items", "left", "list", "outer", "right", "section", "slot", "top", "unit", "wrap", "wrapper"}
DOUBTFUL, IN_MAIN, UNKNOWN, APART = 2, 1, 0, -1
_NEGATIVE = ("no-", "not-", "with-", "without-", "has-")
#: Pages that share so much of the larger one's text are copies.
_COPY = 0.9


def _flagged(name: str, rest: str) -> int:
    """Whether an element's attributes mark it as apart from the text: 2 if so, 1 if some words of a name say so and others don't, else 0."""
    if name in ("html", "body", *_MAIN) and "omment" not in rest:
        return 0
    out = 0
    for m in _ATTR.finditer(rest):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id"):
            words = [w.lower() for one in value.split() for w in _PART.findall(one) if not one.lower().startswith(_NEGATIVE)]
            words = [w for w in words if w not in _NEUTRAL and not w.isdigit()]
            if words and _NAMES.issuperset(words):
                return 2
            out = max(out, int(not _NAMES.isdisjoint(words)))
        elif key == "role" and value.lower() in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return out


def blocks(page: str | None) -> list[tuple[str, int]]:
    """The blocks of text of a page in order, each with IN_MAIN, DOUBTFUL, UNKNOWN or APART. White space is one space; references are decoded."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # elements that may hold blocks, or that are apart
    page, own, place, at = page or "", [], UNKNOWN, 0

    def end() -> None:
        if own:
            text = _SPACE.sub(" ", html.unescape("".join(own))).strip()
            if text:
                out.append((text, place))
            own.clear()

    def close(name: str) -> None:
        nonlocal place
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                del stack[k:]
                place = stack[-1][1] if stack else UNKNOWN
                return

    n = len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            own.append(page[at:])
            break
        if m.start() > at:
            own.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, rest = m[2].lower(), m[3]
        if m[4] != ">":  # cut off inside a tag
            break
        if name in _RAW and not m[1] and not rest.endswith("/"):
            ends = re.compile(rf"</{name}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            at = ends.end() if ends else n
            continue
        if name == "br":
            own.append(" ")
            continue
        if name not in _INLINE:
            end()
        if m[1]:
            if name in _INLINE and any(x == name for x, _ in stack):
                end()
            close(name)
            continue
        if name in _VOID:
            continue
        if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
            close(name)
        elif name in ("body", *_MAIN):
            close("head")
        flag = _flagged(name, rest) if rest else 0
        apart = place == APART or name in _APART or flag == 2
        if name == "header" and place in (IN_MAIN, DOUBTFUL) and flag < 2:
            apart = False  # an article's own heading
        then = APART if apart else IN_MAIN if name in _MAIN else DOUBTFUL if flag and place == IN_MAIN else place
        if then != place and name in _INLINE:
            end()
        if name not in _INLINE or then != place:
            place = then
            if not rest.endswith("/"):
                stack.append((name, place))
    end()
    return out


def _hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) - (1 << 63)


class _Places(dict):
    """The places of a line as bits of an integer. Those of lines with few places are made anew each time if the list is long, since they would take its length squared."""

    def __init__(self, lines: list[int]) -> None:
        self.at: dict[int, list[int]] = {}
        self.size, self.few = len(lines) // 8 + 1, 64 if len(lines) > 1 << 14 else 0
        for k, x in enumerate(lines):
            self.at.setdefault(x, []).append(k)

    def __missing__(self, line: int) -> int:
        held = bytearray(self.size)
        for k in self.at[line]:
            held[k >> 3] |= 1 << (k & 7)
        out = int.from_bytes(held, "little")
        if len(self.at[line]) > self.few:
            self[line] = out
        return out


def shared_lines(a: list[int], b: list[int], most: int = 1 << 28) -> set[int]:
    """The lines of a longest common subsequence of a and b.

    Rows of the dynamic programme are single integers, a bit for each line of b. Where all rows would pass `most` bits,
    some are held and those between are made again when the alignment is traced back; the result is the same.
    """
    known = set(b)
    a = [x for x in a if x in known]
    known = set(a)
    b = [x for x in b if x in known]
    if not a or not b:
        return set()
    if a == b:
        return set(a)
    where = _Places(b)
    full = (1 << len(b)) - 1
    at_once = max(1, most // len(b))
    parts = [(0, len(a), full)]  # the first and last row of each part, and the integer of the first
    out, i, j = set(), len(a), len(b)
    while parts and j:
        low, high, row = parts.pop()
        step = max(1, -(-(high - low) // 16)) if high - low > at_once else 0
        rows = [row]
        for n, x in enumerate(a[low:high], low + 1):
            both = row & where[x]
            row = ((row + both) | (row - both)) & full
            if not step or (n - low) % step == 0 and n < high:
                rows.append(row)
        if step:
            parts += [(k, min(k + step, high), r) for k, r in zip(range(low, high, step), rows, strict=True)]
            continue
        while i > low and j:
            if not rows[i - low] >> (j - 1) & 1:  # the length grows at b[j-1] within the first i lines
                if not rows[i - 1 - low] >> (j - 1) & 1:
                    i -= 1
                else:
                    out.add(b[j - 1])
                    i, j = i - 1, j - 1
            else:
                j -= 1
    return out


def _url_key(url: str | None) -> tuple[str, str]:
    """Host in lower case, and path with what follows."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", url or "")


def _key(page_id: int | None, url: str | None, page: str | None) -> int:
    return xxhash.xxh3_64_intdigest(f"{page_id}\0{url}\0{page}".encode("utf-8", "replace")) - (1 << 63)


@trimmed
def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for one, url, page in zip(b.column("page_id").to_pylist(), b.column("url").to_pylist(), b.column("html"), strict=True):
            page = page.as_py()
            found = blocks(page)
            sizes = [0 if place == APART else len(x) for x, place in found]
            rows.append((_key(one, url, page), *_url_key(url), [_hash(x) for x, _ in found], sizes))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())))], ["key", "host", "path", "lines", "sizes"])


@trimmed
def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages in; each once, with its partition and its place there."""
    part, n, before = TaskContext.get().partitionId(), 0, None
    for b in batches:
        keys = [(h, k) for h, k in zip(b.column("host").to_pylist(), b.column("key").to_pylist(), strict=True)]
        fresh = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else before)]
        before = keys[-1] if keys else before
        b = b.take(pa.array(fresh, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(fresh), pa.int32()), pa.array(range(n, n + len(fresh)), pa.int64()), *(b.column(c) for c in ("host", "key", "lines", "sizes"))], ["part", "place", "host", "key", "lines", "sizes"])
        n += len(fresh)


class _Page:
    """A page's lines as hashes, and how much text markup leaves in each."""

    def __init__(self, lines: list[int], sizes: list[int]) -> None:
        self.lines, self.known = lines, set(lines)
        self.sizes = dict(zip(lines, sizes, strict=True))
        self.total = sum(self.sizes.values())

    def copies(self, other: _Page) -> bool:
        if self.lines == other.lines:
            return True
        least = _COPY * max(self.total, other.total)
        return 0 < least <= min(self.total, other.total) and sum(min(n, other.sizes.get(x, 0)) for x, n in self.sizes.items()) >= least


_SHARED = "host string, line long, run long, pages long"


def _pairs(reach: int, block: int, support: int):
    """The lines that a block's pages share with those near them: for each line up to `support` different pages, and how many pages that is in all."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        own = table.column("block")[0].as_py() * block
        at, hosts, keys = (table.column(c).to_pylist() for c in ("at", "host", "key"))
        pages = [_Page(x, y) for x, y in zip(table.column("lines").to_pylist(), table.column("sizes").to_pylist(), strict=True)]
        runs: list[int] = []  # pages after each other that are copies of the first one are one page
        first = 0
        for i, page in enumerate(pages):
            if i and (hosts[i] != hosts[first] or not pages[first].copies(page)):
                first = i
            runs.append(keys[first])
        found: dict[tuple[str, int], tuple[set, set]] = {}
        for i, page in enumerate(pages):
            if at[i] < own:
                continue
            for j in range(max(0, i - reach), i):
                if hosts[j] == hosts[i] and runs[j] != runs[i] and not page.known.isdisjoint(pages[j].known) and not page.copies(pages[j]):
                    for x in shared_lines(pages[j].lines, page.lines):
                        which, held = found.setdefault((hosts[i], x), (set(), set()))
                        held |= {i, j}
                        if len(which) < support:
                            which |= {runs[i], runs[j]}
        rows = [(host, x, r, len(held) if not k else 0) for (host, x), (which, held) in found.items() for k, r in enumerate(which)]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["host", "line", "run", "pages"])

    return run


@trimmed
def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for page, template in zip(b.column("html"), b.column("template"), strict=True):
            template, found = set(template.as_py() or ()), blocks(page.as_py())
            if template and not any(place in (IN_MAIN, DOUBTFUL) or place == UNKNOWN and _hash(x) not in template for x, place in found):
                template -= {_hash(x) for x, place in found if place == UNKNOWN}  # a page doesn't lose all its text
            kept, shared, apart = [], 0, 0
            for x, place in found:
                if place != IN_MAIN and template and _hash(x) in template:
                    shared += 1
                elif place == APART:
                    apart += 1
                else:
                    kept.append(x)
            out.append(("\n".join(kept), shared, apart))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), *(pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64())))], ["page_id", "url", "text", "n_shared", "n_apart"])


def template_lines(lines: DataFrame, reach: int = 8, support: int = 3, block: int = 256) -> DataFrame:
    """(host, line, pages): the template of each host, from its pages' lines (key, host, path, lines, sizes), with the number of pages that share each line."""
    spark = lines.sparkSession
    ordered = lines.repartitionByRange(partitions(spark), "host", "path", "key").sortWithinPartitions("host", "path", "key")
    placed = stored(ordered.mapInArrow(_placed, "part int, place long, host string, key long, lines array<long>, sizes array<int>"))
    ends, offsets = 0, []
    for r in placed.groupBy("part").agg((F.max("place") + 1).alias("n")).orderBy("part").collect():  # a row a partition
        offsets.append((r.part, ends))
        ends += r.n
    at = placed.join(F.broadcast(spark.createDataFrame(offsets, "part int, earlier long")), "part").withColumn("at", F.col("place") + F.col("earlier"))
    own = F.floor(F.col("at") / block)
    dealt = at.select(F.explode(F.when(F.col("at") % block >= block - reach, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"), "at", "host", "key", "lines", "sizes")
    shared = dealt.groupBy("block").applyInArrow(_pairs(reach, block, support), _SHARED)
    shared = shared.groupBy("host", "line", "run").agg(F.sum("pages").alias("pages"))
    return shared.groupBy("host", "line").agg(F.count("*").alias("runs"), F.sum("pages").alias("pages")).where(F.col("runs") >= support).drop("runs")


#: A template line on more than one of so many pages is common. Common lines are at most this many times the mean number of lines of a page, so they can be broadcast.
_COMMON = 4096


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", reach: int = 8, support: int = 3) -> DataFrame:
    """page_id, url, text (the main text, one line a block), n_shared (blocks deleted as template) and n_apart (blocks that only markup tells) for each row of pages.

    A null page is an empty one, with empty text. A null URL counts as a host of its own name (the empty one). Very
    long pages are read whole. Repeated rows are one page to the pairing and come out as often as they went in; of pages
    with equal URLs the order is by a hash of the row. A host with fewer than `support` different pages has no template:
    its pages are judged by their markup alone. An empty table gives an empty result; further columns are ignored.
    """
    pages = picked(pages, page_id=id_col, url=url_col, html=html_col)
    lines = stored(pages.mapInArrow(_lines, "key long, host string, path string, lines array<long>, sizes array<int>"))
    template = stored(template_lines(lines, reach, support))
    n = lines.count()
    each = lines.select("key", "host", F.explode(F.array_distinct("lines")).alias("line"))
    common = F.col("pages") * _COMMON > n
    held = each.join(F.broadcast(template.where(common)), ["host", "line"]).unionByName(each.join(template.where(~common), ["host", "line"])).drop("pages")
    held = held.groupBy(F.col("key").alias("of")).agg(F.collect_set("line").alias("template"))
    keyed = pages.mapInArrow(_with_key, "page_id long, url string, html string, key long")
    return keyed.join(held, F.col("key") == F.col("of"), "left").select("page_id", "url", "html", "template").mapInArrow(_texts, "page_id long, url string, text string, n_shared long, n_apart long")


@trimmed
def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, urls = b.column("page_id").cast(pa.int64()), b.column("url")
        keys = [_key(one, url, page.as_py()) for one, url, page in zip(ids.to_pylist(), urls.to_pylist(), b.column("html"), strict=True)]
        yield pa.RecordBatch.from_arrays([ids, urls, b.column("html"), pa.array(keys, pa.int64())], ["page_id", "url", "html", "key"])
