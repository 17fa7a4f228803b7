"""Main text of web pages by nearest-URL page differencing.

A page becomes lines, one per block, each with the zone it stands in: the article element (``ARTICLE``), furniture that
its markup names (menus, headers, footers, sidebars, notices, adverts, forms, comments), or neither.  Pages of a host
are put in order of their URL path, and each is paired with the nearer of its two neighbours (longer common path; of
equals the one before); pages without lines are nobody's neighbour, and pages of one path share theirs.  The lines of a pair are aligned by their longest common subsequence, and shared lines outside
an article element are deleted; so are lines of named furniture, which may be different on every page.

Lines inside an article element are kept even if shared: two articles may well quote the same sentence.  Lines that are
neither (a heading beside the article element, a story in a plain ``div``) are kept unless the neighbour shares them; a
page with an article element and no neighbour yields the article alone.  If differencing leaves nothing of a page
(mirrored pages), its lines that are not named furniture stay.

Names are whole class tokens or ids, or their last part ("top-menu") unless the first says otherwise ("no-sidebar").  An element around an article element is no furniture; only asides, menus, footers,
dialogs, adverts and comments are in spite of article elements in them (teasers, single comments), while article lines
stand outside them.  Inside an article only adverts and comments are known by name.

The order of URLs comes from one range shuffle of keys; only the first and last key of each range are joined across
ranges, so a host of any size is spread over tasks.  Null or empty pages have an empty text, a null URL is a host of its
own, rows with equal page_id, url and html get equal results, and extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from timelane.llm.common import read, stage

ARTICLE, FURNITURE, OTHER = 2, 0, 1
#: Fixed lists: elements that end a line, that hold no text, and that are furniture.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("button canvas datalist head iframe noscript object script select style svg template textarea title".split())
#: Furniture that is seldom laid around an article, and that is.
FIRM_TAGS, LOOSE_TAGS = frozenset("aside dialog footer menu nav".split()), frozenset("form header".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Whole class tokens or ids, never parts of one: adverts and comments (also inside an article), and what is furniture only outside.
REMARKS = re.compile(
    r"(?<!\S)(?:ads?(?:[_-](?:banner|box|container|slot|unit|wrapper))?|advert[a-z]*|sponsor[a-z]*|comments?(?:[_-](?:area|form|list|section|thread))?|disqus(?:_thread)?|replies)(?!\S)",
    re.IGNORECASE,
)
NAMED = re.compile(
    r"(?<!\S)(?:banner|breadcrumbs?|cookies?|consent|footer|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo[a-z]*|related|share|sharing|sidebar|social|subscribe|toolbar|widgets?)(?!\S)",
    re.IGNORECASE,
)
LAST_PART = re.compile(r"(?<!\S)(?!(?:has|is|no|not|with|without)[_-])[a-z0-9]+(?:[_-][a-z0-9]+)*[_-](?:ads?|banner|breadcrumbs?|cookies?|footer|menu|modal|nav|navbar|popup|sidebar|toolbar)(?!\S)", re.IGNORECASE)
FIRM_ROLES, LOOSE_ROLES = frozenset("complementary contentinfo menu navigation search".split()), frozenset("banner form".split())


class Place:
    """An open element with a zone, in the one around it.  A ``firm`` one is furniture that articles are not expected in."""

    __slots__ = ("around", "kind", "firm", "hidden", "inside", "holds")

    def __init__(self, around: Place | None, kind: int, firm: bool = False):
        self.around, self.kind, self.firm, self.holds = around, kind, firm, False
        self.hidden = kind == -1 or around is not None and around.hidden
        self.inside = kind == ARTICLE or around is not None and around.inside
        if kind == ARTICLE:
            while around is not None:
                around.holds = True
                around = around.around

    def zone(self, firm: bool) -> int:
        """Furniture that holds an article element is none, unless it is firm and ``firm`` counts."""
        zone, place = OTHER, self
        while place is not None:
            if place.kind == FURNITURE and (not place.holds or firm and place.firm):
                return FURNITURE
            if place.kind == ARTICLE:
                zone = ARTICLE
            place = place.around
        return zone


class Lines(HTMLParser):
    """Collects (text, place) of every block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, Place]] = []
        self.place = self.page = Place(None, OTHER)
        self.open: list[tuple[str, Place]] = []
        self.buffer: list[str] = []

    def end_line(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.lines.append((text, self.place))
            self.buffer = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.end_line()
        elif tag == "br":
            self.buffer.append(" ")
        if tag in VOID or tag == "p":
            return
        facts = {k: v or "" for k, v in attrs}
        inside = self.place.inside
        role = facts.get("role", "").lower()
        names = f"{facts.get('class', '')} {facts.get('id', '')}"
        zone, firm = OTHER, False
        if tag in HIDDEN or "hidden" in facts:
            zone = -1
        elif tag in ("article", "main") or role in ("main", "article") or facts.get("itemprop") == "articleBody":
            firm = tag == "article" and inside and REMARKS.search(names) is not None
            zone = FURNITURE if firm else ARTICLE
        elif tag in FIRM_TAGS or role in FIRM_ROLES:
            zone, firm = FURNITURE, True
        elif tag not in ("body", "html") and REMARKS.search(names):
            zone, firm = FURNITURE, True
        elif tag in LOOSE_TAGS and not (tag == "header" and inside) or role in LOOSE_ROLES:
            zone = FURNITURE
        elif tag not in ("body", "html") and not inside and (NAMED.search(names) or LAST_PART.search(names)):
            zone = FURNITURE
        if zone != OTHER or tag in BLOCKS or any(t == tag for t, _ in self.open):
            if zone != OTHER:
                self.end_line()
                self.place = Place(self.place, zone, firm)
            self.open.append((tag, self.place))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.end_line()
                del self.open[i:]
                self.place = self.open[-1][1] if self.open else self.page
                break

    def handle_data(self, data: str) -> None:
        if not self.place.hidden:
            self.buffer.append(data)


def lines_of(html: str) -> list[tuple[str, int]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    places = {place for _, place in parser.lines}
    zones = {place: place.zone(True) for place in places}
    if ARTICLE not in zones.values():
        zones = {place: place.zone(False) for place in places}
    return [(text, zones[place]) for text, place in parser.lines]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    n, m = len(a), len(b)
    head = 0
    while head < n and head < m and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and tail < m - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    where: dict[int, list[int]] = {}
    for j in range(m - tail - 1, head - 1, -1):
        where.setdefault(b[j], []).append(j)
    # ends[k]: smallest end in b of a common subsequence of k + 1 lines, with its chain of places in a.
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(head, n - tail):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            elif j < ends[k]:
                ends[k], chains[k] = j, chain
    middle, chain = [], chains[-1] if chains else None
    while chain:
        middle.append(chain[0])
        chain = chain[1]
    return [*range(head), *reversed(middle), *range(n - tail, n)]


def split_pages(pages: DataFrame) -> DataFrame:
    """(k, page_id, url, host, path, lines, zones, hashes) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [lines_of(h or "") for h in part["html"].to_pylist()]
                lines = [[t for t, z in f if z != FURNITURE] for f in found]
                zones = [[z for _, z in f] for f in found]
                hashes = [[xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in f] for f in found]
                columns = [pa.array(lines, pa.list_(pa.string())), pa.array(zones, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))]
                rest = part.drop_columns(["html"])
                yield pa.RecordBatch.from_arrays([*rest.columns, *columns], names=[*rest.schema.names, "lines", "zones", "hashes"])

    place = F.regexp_replace(F.col("url"), "^[A-Za-z][A-Za-z0-9+.-]*://|[?#].*$", "")
    source = pages.select(
        F.xxhash64("page_id", "url", "html").alias("k"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.lower(F.substring_index(place, "/", 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(place, "^[^/]*(.*)$", 1), F.lit("")).alias("path"),
        F.col("html").cast("string").alias("html"),
    )
    return source.mapInArrow(run, "k bigint, page_id bigint, url string, host string, path string, lines array<string>, zones array<int>, hashes array<bigint>")


def neighbours(keys: DataFrame) -> DataFrame:
    """(host, path, nk): the page nearest by URL path on the same host, but of another path; of several the smallest k."""
    fact = "struct<host:string,path:string,k:bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, rows = TaskContext.get().partitionId(), None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            own, left, right, ends = zip(*rows)
            kind = pa.struct([("host", pa.string()), ("path", pa.string()), ("k", pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array(own, kind), pa.array(left, kind), pa.array(right, kind), pa.array(ends)], names=["part", "own", "before", "after", "end"])

        held = None
        for batch in batches:
            for row in batch.to_pylist():
                if held is not None:
                    rows.append((held, before, row, before is None))
                    before = held
                held = row
                if len(rows) >= 5000:
                    yield batch_of(rows)
                    rows = []
        if held is not None:
            rows.append((held, before, None, True))
        if rows:
            yield batch_of(rows)

    ordered = keys.groupBy("host", "path").agg(F.min("k").alias("k")).repartitionByRange("host", "path", "k").sortWithinPartitions("host", "path", "k")
    near = stage(ordered.mapInArrow(run, f"part int, own {fact}, before {fact}, after {fact}, end boolean"), "order")
    # At most two rows per range.
    line = Window.orderBy("own")
    ends = near.where("end").select("own", F.coalesce("before", F.lag("own").over(line)).alias("before"), F.coalesce("after", F.lead("own").over(line)).alias("after"))
    near = near.where("NOT end").select("own", "before", "after").unionByName(ends)

    def closeness(side: str) -> Column:
        """Length of the common path; below zero if there is no neighbour on the host."""
        a, b = F.col("own.path"), F.col(f"{side}.path")
        steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(a), F.length(b))))
        same = F.size(F.filter(steps, lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)))
        return F.when(F.col(f"{side}.host") == F.col("own.host"), same).otherwise(F.lit(-1))

    choice = F.when((closeness("before") >= closeness("after")) & (closeness("before") >= 0), F.col("before.k")).when(closeness("after") >= 0, F.col("after.k"))
    return near.select("own.host", "own.path", choice.alias("nk")).where("nk IS NOT NULL")


def shared_lines(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """(k, shared): places of the lines that a page shares with its neighbour."""
    unique = pages.select("k", "hashes").dropDuplicates(["k"])
    other = unique.select(F.col("k").alias("nk"), F.col("hashes").alias("theirs"))
    met = pairs.join(unique, "k").join(other, "nk").select("k", "hashes", "theirs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [common_lines(a, b) for a, b in zip(batch["hashes"].to_pylist(), batch["theirs"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(shared, pa.list_(pa.int32()))], names=["k", "shared"])

    return met.mapInArrow(run, "k bigint, shared array<int>")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_shared (lines shared with its neighbour; null: none to compare with).

    Every page with lines is aligned with its neighbour.  That needs hashes only; a page's lines are then parsed again, so
    that they travel once, to what is known of them, and are not staged as well.
    """
    keys = stage(split_pages(pages).select("k", "host", "path", "hashes"), "keys")
    filled = keys.where(F.size("hashes") > 0).select("host", "path", "k")
    pairs = filled.distinct().join(neighbours(filled), ["host", "path"]).select("k", "nk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for lines, zones, common in zip(*[batch[c].to_pylist() for c in ("lines", "zones", "shared")]):
                # With an article element and nothing to compare with, the other lines are not known to be text.
                gone = set(common if common is not None else range(len(zones)) if ARTICLE in zones else ())
                places = [(i, z) for i, z in enumerate(zones) if z != FURNITURE]
                texts.append("\n".join([t for t, (i, z) in zip(lines, places) if z == ARTICLE or i not in gone] or lines))
            n_shared = pc.list_value_length(batch["shared"])
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), n_shared], names=["page_id", "url", "text", "n_shared"])

    split = split_pages(pages).select("k", "page_id", "url", "lines", "zones")
    differenced = split.join(shared_lines(keys, pairs), "k", "left").select("page_id", "url", "lines", "zones", "shared")
    out = differenced.mapInArrow(run, "page_id bigint, url string, text string, n_shared int")
    return out.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "n_shared")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(read(spark, folder, "pages"))
