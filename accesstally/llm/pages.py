"""Main text of web pages, by markup and by differencing pages with near URLs.

A page becomes lines, one for each block of text, that know whether they lie in the page's article and
whether in a part that is never article (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments, by element or by whole names of class, id and role). What is such a part by its name
alone and holds the page's first article is none. Pages are sorted by host and path
over all tasks, and each is compared with the nearest page before or after it that holds other lines,
the one that shares the longer beginning of its path, or with both where they share as much: lines are aligned by a longest common subsequence, and shared lines are the site's and go.

A page that marks its article (``article``, else ``main`` or its role) says itself what is the site's:
there, shared lines go from everywhere but the article, as a paragraph that two articles quote belongs to
both, and lines of its own outside the article stay. Without such a mark shared lines go from the whole page. A page with the same
lines throughout is a copy and says nothing about the site, so it is passed over.

The order is by host, path, number, URL and lines, cut into buckets of about equal bytes, so a large host
is spread over tasks. The cuts are found on keys alone, which are sorted first: a key is a page's place in
the order and a digest of its lines. They also say which page lies before a bucket's first page and after
its last one, past copies, and those few pages go to both buckets. So results do not depend on the number
of buckets or tasks. Pages are then shuffled once; a task holds three pages at a time, and of copies in a
row the numbers, URLs and flags.

Cases: null and empty html give the empty text. Pages without a usable URL are sorted together under an
empty host and not compared. Repeated rows are extracted one by one; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from accesstally.llm.sharding import sharded
from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import scratch_path, written

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is none of the page's.
UNSEEN = frozenset("head title style script noscript template svg math iframe object canvas audio video select option datalist button textarea form".split())
#: Elements that hold the site's text.
SITE = frozenset("nav aside footer menu dialog".split())
RAW = frozenset("script style textarea title".split())
#: Words of class, id and role that name a part of the site; ``HEADER`` only outside the article.
SITE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe share sharing "
    "social related recommended comment comments disqus respond replies widget toolbar login search pagination pager copyright "
    "complementary contentinfo".split()
)
HEADER = frozenset("header masthead".split())
#: Elements an opening tag closes when they are still open.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}}
STOPS = frozenset("ul ol table dl article section div body nav aside main form td th".split())

#: Words that only say where or of what kind a part of the site is: "main-nav", "ad-slot", "site-footer".
PLACE_WORDS = frozenset(
    "site main page global top bottom left right primary secondary upper lower inner outer first second js fixed sticky mobile desktop "
    "box bar block wrapper wrap container list area section group item items link links slot unit form button buttons icon icons "
    "text body content post entry article blog header media message signup open small large".split()
)

_name = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_plain = re.compile(r"[^>\"']*")
_named = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_parts = re.compile(r"[a-z]+")

Line = tuple[str, bool, bool]


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the ``>`` of a tag is whose inside begins at ``at``, or -1.

    A quoted value may hold ``>``; a quote that nothing closes is a character like others. ``last`` has
    the last place of each sign, so that a search which must fail is not begun.
    """
    i = at
    while i <= last[">"]:
        i = _plain.match(page, i).end()
        if i >= len(page):
            break
        if page[i] == ">":
            return i
        i = page.index(page[i], i + 1) + 1 if last[page[i]] > i else i + 1
    return page.find(">", at) if at <= last[">"] else -1


def site_words(value: str, mine: frozenset) -> bool:
    """Whether a class, id or role names a part of the site.

    A name does that as a whole, or when all of its words name parts or places of a site and one of them
    a part: "cookie-banner" does; "with-sidebar", "social-studies" and "share-price" do not.
    """
    for token in value.lower().split():
        words = _parts.findall(token)
        if token in mine or any(w in mine for w in words) and all(w in mine or w in PLACE_WORDS for w in words):
            return True
    return False


def lines_of(page: str | None) -> list[Line]:
    """(text, in the article, in a part of the site) of every block with text, in page order.

    Takes time in proportion to the page: places of open elements are kept by name, and the rest of a
    page without any ``>`` is text.
    """
    if not page:
        return []
    found: list[Line] = []
    # name, unseen, part of the site (1 by its class, 2 by its element), article from here on
    stack: list[tuple[str, bool, int, bool]] = []
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    unseen, site, article = False, 0, False
    seen_article = False
    pieces: list[str] = []
    last = {sign: page.rfind(sign) for sign in ">\"'"}

    def flush():
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            found.append((text, article, bool(site)))
        pieces.clear()

    def close(down_to):
        nonlocal unseen, site, article
        while len(stack) > down_to:
            name = stack.pop()[0]
            places[name].pop()
            if name in BLOCKS:
                blocks.pop()
        _, unseen, site, article = stack[-1] if stack else ("", False, 0, False)

    def innermost(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start != at:
            start = len(page) if start < 0 else start
            if not unseen:
                pieces.append(page[at:start])
            at = start
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = len(page) if end < 0 else end + 3
            continue
        tag = _name.match(page, at)
        bang = page.startswith(("<!", "<?"), at)
        end = (page.find(">", at) if at <= last[">"] else -1) if bang else _tag_end(page, tag.end(), last) if tag else -1
        if end < 0:
            if not unseen:
                pieces.append("<")
            at += 1
            continue
        at = end + 1
        if bang:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in BLOCKS:
                flush()
            elif name in ("td", "th"):
                pieces.append(" ")
            i = innermost((name,))
            if i >= 0 and (name in BLOCKS or name in UNSEEN or not blocks or blocks[-1] <= i):
                close(i)
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            pieces.append(" ")
        if name in CLOSES:
            i = innermost(CLOSES[name])
            if i >= 0 and i >= innermost(STOPS):
                close(i)
        inside = page[tag.end() : end]
        if name in VOID or inside.endswith("/") and name not in BLOCKS:
            continue
        named = [(a[1].lower(), a[2] or a[3] or a[4] or "") for a in _named.finditer(inside)] if inside else []
        marks_article = name in ("article", "main") or any(kind == "role" and "main" in value.lower().split() for kind, value in named)
        if site == 1 and marks_article and not article and not seen_article:
            site = 0  # what holds the page's article is no part of the site, whatever it is called
        marks_article = marks_article and not site
        mine = SITE_WORDS if article or marks_article else SITE_WORDS | HEADER
        if name not in ("html", "body") and not site:
            if name in SITE or name == "header" and not article:
                site, marks_article = 2, False
            elif not marks_article and any(site_words(value, mine) for _, value in named):
                site = 1
        unseen = unseen or name in UNSEEN
        article = article or marks_article
        seen_article = seen_article or marks_article
        places.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        stack.append((name, unseen, site, article))
        if name in RAW:
            ended = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = ended.end() if ended else len(page)
            close(len(stack) - 1)
    flush()
    return found


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of the lines of a longest common subsequence of both."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared = set(range(head)) | set(range(len(a) - tail, len(a)))
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    return shared | {head + i for i in _between(x, y)}


#: Bits of rows that are kept to follow a subsequence back; larger pairs are halved first.
FOLLOWED = 200_000_000


def _rows(x: list[str], y: list[str]) -> Iterator[int]:
    """After each line of ``x``: bit j is 0 where a longer common subsequence with ``y`` up to j ends."""
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = row = (1 << len(y)) - 1
    for line in x:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(x: list[str], y: list[str]) -> np.ndarray:
    """Lengths of longest common subsequences of ``x`` with each beginning of ``y``."""
    row = (1 << len(y)) - 1
    for row in _rows(x, y):  # noqa: B007  the last one
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _between(x: list[str], y: list[str]) -> set[int]:
    if not x or not y:
        return set()
    if len(x) > 1 and len(x) * len(y) > FOLLOWED:
        half = len(x) // 2
        cut = int((_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]).argmax())
        return _between(x[:half], y[:cut]) | {half + i for i in _between(x[half:], y[cut:])}
    rows, found = list(_rows(x, y)), set()
    j = len(y) - 1
    for i in range(len(x) - 1, -1, -1):
        # places that end no longer subsequence are passed over; one that does so without line i too stays
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        if not i or rows[i - 1] >> j & 1:
            found.add(i)
            j -= 1
    return found


def main_text(own: list[Line], others: list[list[Line]]) -> str:
    """The lines that are left of a page beside its neighbours'."""
    return left_of(own, [[line[0] for line in other] for other in others])


def left_of(own: list[Line], others: list[list[str]]) -> str:
    texts = [line[0] for line in own]
    shared: set[int] = set()
    for theirs in others:
        if theirs != texts:
            shared |= common(texts, theirs)
    kept = []
    for i, (text, article, site) in enumerate(own):
        if site or i in shared and not article:
            continue
        kept.append(text)
    return "\n".join(kept)


Key = tuple[str, str, int, str, bytes]  # host, path, number, URL and digest of the lines: the order of pages
_KEY = "struct<host:string,path:string,number:bigint,url:string,digest:binary>"
_KEY_ARROW = pa.struct([("host", pa.string()), ("path", pa.string()), ("number", pa.int64()), ("url", pa.string()), ("digest", pa.binary())])
_LEAST = -(2**63)


def _key(page_id: int | None, url: str | None, lines: list[Line]) -> Key:
    split = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", (url or "").lower())
    host, path = split.groups() if split else ("", "")
    texts = "\n".join(line[0] for line in lines).encode("utf-8", "surrogatepass")
    return host, path, _LEAST if page_id is None else page_id, url or "", hashlib.blake2b(texts, digest_size=16).digest()


class Edge(NamedTuple):
    """A run of pages of one host with equal lines, at an end of a bucket."""

    bucket: int
    host: str
    digest: bytes
    first: Key
    last: Key


def borders(edges: list[list[Edge]]) -> dict[Key, list[tuple[int, int]]]:
    """Which pages other buckets need: key to (bucket, -1 for one before its pages or 1 for one after them).

    ``edges`` has for every bucket in order its runs, of which all but the first and last two may be
    missing. A run that goes on over several buckets needs the page before its start, and the one after
    its end, in each of them.
    """
    found: dict[Key, list[tuple[int, int]]] = {}
    for side, buckets in ((-1, edges), (1, [runs[::-1] for runs in edges[::-1]])):
        passed: list[Edge] = []  # the last run of other lines than the latest one, and the latest one
        for runs in buckets:
            own = runs[0]
            same = passed and (passed[-1].host, passed[-1].digest) == (own.host, own.digest)
            other = passed[-2] if same and len(passed) > 1 else passed[-1] if passed and not same else None
            if other and other.host == own.host and own.host:
                found.setdefault(other.last if side < 0 else other.first, []).append((own.bucket, side))
            for run in runs:
                if passed and (passed[-1].host, passed[-1].digest) == (run.host, run.digest):
                    joined = passed[-1]._replace(last=run.last) if side < 0 else passed[-1]._replace(first=run.first)
                    passed = [*passed[-2:-1], joined]
                else:
                    passed = [*passed[-1:], run]
    return found


def _pieces(batches, size: int):
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _buckets(rows: DataFrame, most: int) -> tuple[list[Key], dict[Key, list[tuple[int, int]]]]:
    """The first keys of all buckets but the first, of about equal bytes, and the pages that lie at borders.

    Only keys are sorted and written. What comes to the driver are at most five keys for each bucket.
    """

    def keyed(batches):
        for part in _pieces(batches, 500):
            found = [lines_of(p) for p in part.column(2).to_pylist()]
            keys = [_key(i, u, f) for i, u, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), found, strict=True)]
            keys = pa.array([dict(zip(("host", "path", "number", "url", "digest"), k, strict=True)) for k in keys], _KEY_ARROW)
            sizes = pa.array([sum(len(line[0]) for line in f) + 1 for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, sizes], names=["key", "bytes"])

    narrow = rows.mapInArrow(released(keyed), f"key {_KEY}, bytes long")
    placed = sharded(written(narrow, scratch_path(rows.sparkSession, "page-keys")), F.col("bytes"), [F.col("key")], most)
    bounds = sorted(tuple(r["key"]) for r in placed.groupBy("shard").agg(F.min("key").alias("key")).collect())[1:]
    bounds = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in key) for key in bounds]

    def numbered(batches):
        for part in _pieces(batches, 10_000):
            at = [bisect.bisect_right(bounds, tuple(k.values())) for k in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at, pa.int32())], names=["key", "bucket"])

    within = Window.partitionBy("bucket").orderBy("key")
    other = F.lag("key").over(within)
    new = (other["host"] != F.col("key.host")) | (other["digest"] != F.col("key.digest"))
    keys = placed.select("key").mapInArrow(released(numbered), f"key {_KEY}, bucket int")
    keys = keys.withColumn("new", F.coalesce(new, F.lit(True)).cast("long"))
    keys = keys.withColumn("run", F.sum("new").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    runs = keys.groupBy("bucket", "run").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    from_end = F.max("run").over(Window.partitionBy("bucket")) - F.col("run")
    ends = runs.withColumn("from_end", from_end).filter("run <= 2 OR from_end < 2")
    plain = lambda key: tuple(bytes(x) if isinstance(x, bytearray) else x for x in key)
    edges: dict[int, list[Edge]] = {}
    for r in sorted(ends.collect(), key=lambda r: (r["bucket"], r["run"])):
        first, last = plain(r["first"]), plain(r["last"])
        edges.setdefault(r["bucket"], []).append(Edge(r["bucket"], first[0], first[4], first, last))
    return bounds, borders([edges[b] for b in sorted(edges)])


def extract(pages: DataFrame, page: str = "html", url: str = "url", page_id: str = "page_id", buckets: int | None = None) -> DataFrame:
    """page_id, url and text of every page; ``buckets`` defaults to the session's shuffle partitions."""
    spark = importable(pages.sparkSession)
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
    bounds, imported = _buckets(rows, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def parse(batches):
        """Every page for its own bucket, and pages at borders for those that they are compared in as well."""
        for part in _pieces(batches, 500):
            made = []
            for number, address, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                lines = lines_of(text)
                key = _key(number, address, lines)
                own = (bisect.bisect_right(bounds, key), 0)
                row = (key, number, address, [x[0] for x in lines], bytes(x[1] + 2 * x[2] for x in lines))
                made += [(bucket, side, *row) for bucket, side in (own, *imported.get(key, ()))]
            columns = list(zip(*made, strict=True)) or [[]] * 7
            keys = pa.array([dict(zip(("host", "path", "number", "url", "digest"), k, strict=True)) for k in columns[2]], _KEY_ARROW)
            kinds = [pa.int32(), pa.int32(), None, pa.int64(), pa.string(), pa.list_(pa.string()), pa.binary()]
            arrays = [keys if kind is None else pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "side", "key", "page_id", "url", "lines", "flags"])

    def near(a, b) -> int:
        """How much of their paths two pages of a host share; -1 for none to compare."""
        if a is None or b is None or not a[0] or a[0] != b[0]:
            return -1
        n = 0
        while n < min(len(a[1]), len(b[1])) and a[1][n] == b[1][n]:
            n += 1
        return n

    def compare(batches):
        bucket = before = here = None  # the last page with other lines, and the first of the pages with equal lines
        same: list[tuple] = []  # number, URL, path and flags of those: their lines are held once
        texts: list[tuple] = []

        def judged(after):
            for number, address, path, flags in same:
                own = [(t, bool(f & 1), bool(f & 2)) for t, f in zip(here[2], flags, strict=True)]
                page = (here[0], path)
                left, right = near(page, before), near(page, after)
                nearest = max(left, right, 0)
                others = [other[2] for other, shared in ((before, left), (after, right)) if shared == nearest]
                texts.append((number, address, left_of(own, others)))
                if len(texts) >= 500:
                    yield batch_of()
                    texts.clear()
            same.clear()

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*texts, strict=True), out, strict=True)], schema=out)

        for part in _pieces(batches, 200):
            for at, side, key, number, address, lines, flags in zip(*(part.column(i).to_pylist() for i in range(7)), strict=True):
                row = (key["host"], key["path"], lines)
                if here is not None and at != bucket:
                    yield from judged(None)
                    before = here = None
                elif here is not None and (row[0] != here[0] or lines != here[2]):
                    yield from judged(row)
                    before, here = here, None
                elif here is not None:
                    here = (here[0], row[1], here[2])  # the path of the last one, which is nearest to what follows
                bucket = at
                if here is None:
                    here = row
                if side == 0:
                    same.append((number, address, row[1], flags))
        if here is not None:
            yield from judged(None)
        if texts:
            yield batch_of()

    found = rows.mapInArrow(released(parse), f"bucket int, side int, key {_KEY}, page_id long, url string, lines array<string>, flags binary")
    found = found.repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions("bucket", "side", "key", "flags")
    return found.mapInArrow(released(compare), "page_id long, url string, text string")


def op5_pages(spark, sf_dir):
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
