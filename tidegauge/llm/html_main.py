"""Main text of pages by differencing each with its nearest neighbour.

A page becomes lines, one per block of text. Within a host, pages are sorted by URL path; a page's
neighbours in that order share the longest beginnings of paths with it. Lines that a longest common
subsequence aligns with those of the nearer neighbour belong to the site, not to the page, and go.

Differencing alone is wrong in two ways: an article's own lines may stand on a neighbour as well, and
menus, notices or adverts may differ from page to page. So markup that says what a block is decides
first: blocks inside an article or main element stay, blocks in navigation, headers, footers, asides,
forms, adverts, notices or comments go. Differencing decides the rest, the blocks that no markup
classifies. It aligns all lines of all pages, whatever markup says of them, by their hashes; neighbours
with the very same lines are passed over. Texts are moved only of pages that have undecided blocks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from os.path import commonprefix
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import shared_dir, small_batches, written

# fixed values: elements by what they do to text
SILENT = {"script", "style", "noscript", "template", "textarea", "select", "svg", "head", "title", "iframe", "object", "math"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}  # end only with their own end tag
AWAY = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# elements that a start tag closes without their end tags: which, and what stands between them and it at most
CLOSE_P = (BLOCKS | VOID & {"hr"}) - {"body", "caption", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
P_SCOPE = {"button", "caption", "html", "object", "table", "td", "template", "th"}
ITEM = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
ITEM_SCOPE = (BLOCKS | AWAY | MAIN) - {"address", "div", "p"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SECTIONS = {"tbody", "tfoot", "thead"}
TABLE = {"td": {"tr", "table", *SECTIONS}, "th": {"tr", "table", *SECTIONS}, "tr": {"table", *SECTIONS}}
TABLE |= dict.fromkeys([*SECTIONS, "caption"], {"table"})
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
# words that, as a whole class or id, name what is not the page's own text
_AWAY_WORD = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|footer|header|masthead|cookies?|consent|"
    r"notice|popup|modal|newsletter|subscribe|share|social|related|recommend\w*|widget|pagination|copyright)"
)
_COMMENT_WORD = r"(?:comments?|replies|disqus)"
# such a word may have one before it that does not deny it, or a container's name after it
_BEFORE = r"(?:(?!(?:no|not|non|has|have|with|without|is|js|show|hide|hidden|enable|disable)[-_])[a-z]+[-_])?"
_AFTER = r"(?:[-_](?:area|banner|bar|block|box|buttons?|container|form|items?|links?|list|menu|notice|posts|section|slot|unit|widget|wrap|wrapper))?"
_AWAY_NAME = re.compile(_BEFORE + _AWAY_WORD + _AFTER, re.I)
_COMMENT_NAME = re.compile(_BEFORE + _COMMENT_WORD + _AFTER, re.I)
_AWAY_ROLE = {"alertdialog", "banner", "complementary", "contentinfo", "dialog", "menu", "menubar", "navigation", "search", "toolbar"}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>?|<[!?][^>]*>?", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACE = re.compile(r"\s+")

OWN, UNKNOWN, SITE = 2, 1, 0
SOFT = 3  # SITE by a name only: an article inside shows that the name meant something else


def _role(name: str, attributes: str) -> int:
    """What an element says about its text: OWN, SITE, SOFT, or UNKNOWN for nothing; -1 for no text at all.
    Names given to the whole page say nothing."""
    if name in SILENT or (attributes and _HIDDEN.search(attributes)):
        return -1
    if name in AWAY:
        return SITE
    said = OWN if name in MAIN else UNKNOWN
    for m in _NAMED.finditer(attributes) if attributes and name not in ("html", "body") else ():
        for token in (m[2] or m[3] or m[4] or "").split():
            if m[1].lower() == "role":
                if token.lower() in _AWAY_ROLE:
                    return SITE
                said = OWN if token.lower() in MAIN else said
            elif _COMMENT_NAME.fullmatch(token):
                return SITE
            elif _AWAY_NAME.fullmatch(token):
                said = SOFT
    return said


def _closed(name: str, names: list[str]) -> int:
    """How many of the open elements ``names`` stay open when ``name`` starts, by HTML's implied end tags."""
    keep = len(names)
    if name not in IN_HEAD and "head" in names:
        keep = names.index("head")
    for i in range(keep - 1, -1, -1) if name in TABLE else ():
        if names[i] in TABLE[name]:
            return i + 1
    for i in range(keep - 1, -1, -1) if name in ITEM else ():
        if names[i] in ITEM[name]:
            keep = i
            break
        if names[i] in ITEM_SCOPE:
            break
    for i in range(keep - 1, -1, -1) if name in CLOSE_P else ():
        if names[i] == "p":
            keep = i
            break
        if names[i] in P_SCOPE:
            break
    if keep and len(name) == 2 and name in HEADINGS and names[keep - 1] in HEADINGS:
        keep -= 1
    return keep


def blocks(page: str) -> list[tuple[int, str]]:
    """(role, text) of each block with text, in page order. Tags need not be balanced: an end tag
    closes the nearest open element of its name, and with it what stands open inside; a start tag closes
    what HTML lets end without an end tag."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    open_: list[tuple[str, int]] = []  # blocks and elements that change the role, with the role inside

    def flush() -> None:
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if line:
                role = open_[-1][1] if open_ else UNKNOWN
                out.append((SITE if role == SOFT else role, line))
            text.clear()

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else end
        role = open_[-1][1] if open_ else UNKNOWN
        if stop > at and role >= 0:
            text.append(page[at:stop])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS or name in AWAY:
            flush()
        elif name == "br" and role >= 0:
            text.append(" ")
        if tag[1]:
            names = [n for n, _ in open_]
            if name in names:
                flush()
                del open_[len(names) - 1 - names[::-1].index(name) :]
            continue
        if open_ and (name in BLOCKS or open_[-1][0] == "head"):
            del open_[_closed(name, [n for n, _ in open_]) :]
            role = open_[-1][1] if open_ else UNKNOWN
        if name in VOID or tag[3].endswith("/"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        said = _role(name, tag[3])
        if said != UNKNOWN or name in BLOCKS or any(n == name for n, _ in open_):
            # what is away stays away, whatever stands inside; own text stays own unless it says otherwise
            stays = said == UNKNOWN or role in (-1, SITE) or (role == SOFT and said == OWN and name not in MAIN)
            inner = role if stays else said
            if inner != role:
                flush()
            open_.append((name, inner))
    flush()
    return out


def place(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; what cannot be read as one is a path without host."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", url or ""


def _hashed(lines: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(line) for line in lines], np.uint64)


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each of ``a`` stands in a longest common subsequence of both: patience-style, by the longest
    increasing run of places in ``b`` (each line's places in falling order)."""
    keep = np.zeros(len(a), bool)
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        where.setdefault(x, []).append(j)
    tops: list[int] = []
    chains: list[tuple[int, tuple | None]] = []
    for i, x in enumerate(a.tolist()):
        for j in reversed(where.get(x, ())):
            k = int(np.searchsorted(tops, j))
            link = (i, chains[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                chains.append(link)
            else:
                tops[k], chains[k] = j, link
    node = chains[-1] if chains else None
    while node:
        keep[node[0]] = True
        node = node[1]
    return keep


PARSED = "page_id long, url string, host string, path string, roles binary, hashes binary, lines array<string>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Roles and hashes of all lines, texts of those that may stay."""
    for batch in small_batches(batches, "html"):
        found = [blocks(page or "") for page in batch.column("html").to_pylist()]
        places = [place(u) for u in batch.column("url").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array([h for h, _ in places], pa.string()),
                pa.array([p for _, p in places], pa.string()),
                pa.array([bytes(r for r, _ in f) for f in found], pa.binary()),
                pa.array([_hashed([t for _, t in f]).tobytes() for f in found], pa.binary()),
                pa.array([[t for r, t in f if r != SITE] for f in found], pa.list_(pa.string())),
            ],
            names=["page_id", "url", "host", "path", "roles", "hashes", "lines"],
        )


# a page in the order of URLs: (host, path, hashes of its lines as bytes)
Place = tuple[str, str, bytes]


def _places(batch: pa.RecordBatch) -> Iterator[Place]:
    return zip(*(batch.column(c).to_pylist() for c in ("host", "path", "hashes")))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's first and last page (nth 0), and those nearest to them of other content (nth 1)."""
    first: list[Place] = []
    last: list[Place] = []
    part = None
    for batch in batches:
        for page in _places(batch):
            if len(first) < 2 and (not first or page[2] != first[0][2]):
                first.append(page)
            last = [page, *(last[:1] if last and last[0][2] != page[2] else last[1:])]
        part = batch.column("part")[0].as_py() if batch.num_rows else part
    rows = [(part, end, n, *page) for end, pages in ((False, first), (True, last)) for n, page in enumerate(pages)]
    if rows:
        kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "last", "nth", "host", "path", "hashes"])


def _beyond(parts: list[int], ends: dict[int, list[Place]]) -> dict[int, list[Place]]:
    """By partition, in the order of ``parts``: the nearest page of those before it, and the nearest of other
    content than that one's. ``ends`` has the same two of a partition's own pages."""
    out, carried = {}, []
    for p in parts:
        out[p] = carried
        carried = [*ends[p], *(x for x in carried if x[2] != ends[p][0][2])][:2]
    return out


def _near(page: Place, other: Place | None) -> int:
    """How much of the path two pages of one host share; -1 for pages of different hosts or none."""
    return len(commonprefix([page[1], other[1]])) if other and other[0] == page[0] else -1


def _differenced(before: dict[int, list[Place]], after: dict[int, list[Place]]):
    """Flags of the lines that a page shares with its nearest neighbour of other content, by row."""

    def told(run: list[tuple[int, bool, Place]], left: Place | None, right: Place | None) -> Iterator[tuple[int, bytes]]:
        """A run of pages of equal content, and the pages before and after it."""
        here, flags = run[0][2][2], {}
        for row, open_, page in run:
            near = (_near(page, left), _near(page, right))
            if open_ and max(near) >= 0:
                side = int(near[0] < near[1])
                if side not in flags:
                    other = (left, right)[side][2]
                    flags[side] = common_lines(np.frombuffer(here, np.uint64), np.frombuffer(other, np.uint64)).tobytes()
                yield row, flags[side]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, left, part, out = [], None, None, []
        for batch in small_batches(batches, "hashes"):
            for row, open_, number, page in zip(*(batch.column(c).to_pylist() for c in ("row", "open", "part")), _places(batch)):
                if not run:
                    part = number
                    left = next((x for x in before[part] if x[2] != page[2]), None)
                elif run[0][2][2] != page[2]:
                    out += told(run, left, page)
                    left, run = run[-1][2], []
                run.append((row, open_, page))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["row", "shared"])
                out = []
        out = list(told(run, left, next((x for x in after[part] if x[2] != run[0][2][2]), None))) if run else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["row", "shared"])

    return scan


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of pages with undecided lines: their own lines, and those undecided that are not shared."""
    for batch in batches:
        texts, gone = [], []
        for roles, lines, shared in zip(*(batch.column(c).to_pylist() for c in ("roles", "lines", "shared"))):
            left = [(r, s) for r, s in zip(roles, shared or bytes(len(roles))) if r != SITE]
            drop = [r == UNKNOWN and s for r, s in left]
            texts.append("\n".join(t for t, d in zip(lines, drop) if not d))
            gone.append(sum(map(bool, drop)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(gone, pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars", "n_shared"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_shared (undecided lines
    that went as shared). Blocks are joined by line feeds; pages without text have an empty one. Null
    html is empty; null or unreadable URLs share one host without name. Among pages of equal host and
    path, the smaller page_id comes first (null before all). Neighbours without lines, or with the same
    lines as the page, tell nothing and are passed over.
    """
    spark = pages.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parsed = pages.select("page_id", "url", "html").mapInArrow(_parsed, PARSED)
    parsed = written(parsed.withColumn("row", F.monotonically_increasing_id()), "lines")
    parsed = parsed.withColumn("open", F.hex("roles").rlike(f"^(?:..)*0{UNKNOWN}"))
    text = F.concat_ws("\n", "lines")
    decided = parsed.where(~F.col("open")).select(
        "page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.lit(0).cast("long").alias("n_shared")
    )
    # every page with lines is a neighbour, whatever markup decides of it; only hashes of lines are moved
    order = ["host", "path", "page_id", "row"]
    rows = parsed.where("length(hashes) > 0").select(*order, "open", "hashes").repartitionByRange(tasks, *order)
    rows = rows.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).checkpoint()
    # four pages of each partition, by which neighbours find each other across partitions
    ends = rows.select("part", "host", "path", "hashes").mapInArrow(
        _ends, "part int, last boolean, nth int, host string, path string, hashes binary"
    )
    found: dict[bool, dict[int, list[Place]]] = {False: {}, True: {}}
    for r in sorted(ends.collect(), key=lambda r: r["nth"]):
        found[r["last"]].setdefault(r["part"], []).append((r["host"], r["path"], bytes(r["hashes"])))
    parts = sorted(found[True])
    scan = _differenced(_beyond(parts, found[True]), _beyond(parts[::-1], found[False]))
    shared = rows.select("row", "open", "part", "host", "path", "hashes").mapInArrow(scan, "row long, shared binary")
    open_ = parsed.where("open").select("row", "page_id", "url", "roles", "lines").join(shared, "row", "left").drop("row")
    return decided.union(open_.mapInArrow(_chosen, "page_id long, url string, text string, n_chars long, n_shared long"))
