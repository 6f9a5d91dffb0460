"""Main text of web pages by consensus paths of their host.

Each page's containers are scored. From the largest article or main element, or the whole page, a
page proposes to go down to smaller containers that hold most of the text. It may do so only past
text that is links, or that other pages of the host repeat word for word, so that headings and
openings beside a large block stay. Every container has a generalised path: the tags and classes
down to it, digits made equal. Pages vote per host, by grouped aggregation: a path's score is the
share of the pages having it that chose it. Each page is then extracted anew from the containers on
its best-scored path, so that a page that would have been misjudged alone follows the others of its
host.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    "annotation annotation-xml math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtable mtd mtext mtr munder munderover semantics".split()
)
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
SEMANTIC = frozenset(("article", "main"))
DROPPED = frozenset(
    "annotation annotation-xml applet aside audio button canvas datalist dialog embed fieldset footer form frame frameset head header iframe input "
    "legend map menu meter nav noframes noscript object optgroup option output progress script select style svg "
    "template textarea title video".split()
)
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
#: Class or id names of what is not the article, with usual parts before and after.
_PARTS = (
    "site page main top bottom left right global primary secondary header footer post article blog user reader inner outer fixed sticky "
    "bar box list block wrap wrapper container section area content panel item link links form thread unit slot text".split()
)
_NAMES = (
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs crumbs header masthead footer sidebar aside rail widget widgets related recommended recommendations "
    "share sharing social cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login search comment comments commentlist respond reply replies discussion disqus pagination pager toolbar "
    "copyright disclaimer skip".split()
)
_DROPPED_NAME = re.compile(
    rf"(?:(?:{'|'.join(_PARTS)}|\d+)[-_]*)*(?:{'|'.join(_NAMES)})(?:[-_]*(?:{'|'.join(_PARTS + _NAMES)}|\d+))*", re.I
)
#: Names of what readers wrote; it may well be longer than the article.
_READERS = re.compile(r"comment|repl(?:y|ies)|respond|discussion|disqus", re.I)
#: A start tag on the left ends an open element on the right, if no element of the third kind is between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
BULK = 0.8  # of its parent's text, for a container to stand for its parent
LINKED = 0.5  # of a block's characters, for it to be links rather than text
MOST = 0.6  # of a page's text, for an element to hold the article whatever its name


def dropped(tag: str, attrs: dict[str, str | None]) -> bool:
    """Whether an element is not part of an article, by its tag or role."""
    if tag in DROPPED or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    return (attrs.get("role") or "").lower() in DROPPED_ROLES


def doubtful(tag: str, attrs: dict[str, str | None]) -> list[str]:
    """The names of an element by which it would not be part of an article."""
    if tag in ("html", "body", "article", "main"):
        return []
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return [name for name in names if len(name) < 80 and _DROPPED_NAME.fullmatch(name)]


class Page(HTMLParser):
    """Blocks of text of a page and its containers as ranges of blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.plain: list[int] = []  # characters of a block outside links
        self.containers: list[dict] = [{"tag": "", "path": "0" * 16, "first": 0, "last": 0, "parent": -1}]
        self.stack: list[tuple[str, int, bool, int]] = []  # tag, container or -1, dropped, doubtful element or -1
        self.doubtful: list[list] = []  # first block, last block, whether readers wrote it
        self.open: Counter[str] = Counter()
        self.skipping = 0
        self.text: list[str] = []
        self.linked = 0
        self.inside = [0]  # open containers
        self.feed(html)
        self.close()
        while self.stack:
            self._pop()
        self._flush()
        self.containers[0]["last"] = len(self.blocks)
        self._leave_out()

    def _leave_out(self) -> None:
        """Mark the blocks of doubtful elements, but for those that hold the article or most of the text."""
        self.gone = [False] * len(self.blocks)

        def leave(first: int, last: int) -> None:
            self.gone[first:last] = [True] * (last - first)

        for first, last, readers in self.doubtful:
            if readers:
                leave(first, last)
        sums = self._sums()
        articles = [c for c in self.containers if c["tag"] in SEMANTIC]
        article = max(articles, key=lambda c: sums[c["last"]] - sums[c["first"]], default=None)
        if article and sums[article["last"]] == sums[article["first"]]:
            article = None
        for first, last, readers in self.doubtful:
            holds = article and first <= article["first"] and article["last"] <= last
            if not readers and not holds and sums[last] - sums[first] < MOST * sums[-1]:
                leave(first, last)

    def _sums(self) -> list[int]:
        """Characters outside links of the blocks before each place."""
        sums = [0]
        for n, gone in zip(self.plain, self.gone):
            sums.append(sums[-1] + (0 if gone else n))
        return sums

    def _flush(self) -> None:
        if self.text:
            block = " ".join("".join(self.text).split())
            if block:
                self.blocks.append(block)
                self.plain.append(max(0, len(block) - self.linked))
            self.text = []
        self.linked = 0

    def _pop(self) -> None:
        tag, container, out, doubt = self.stack.pop()
        self.open[tag] -= 1
        if tag not in INLINE:
            self._flush()
        if out:
            self.skipping -= 1
        if container >= 0:
            self.containers[container]["last"] = len(self.blocks)
            self.inside.pop()
        if doubt >= 0:
            self.doubtful[doubt][1] = len(self.blocks)

    def _close_open(self, tags: set[str], fence: set[str]) -> None:
        if not any(self.open[t] > 0 for t in tags):
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] in tags:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth][0] in fence:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self._flush()
            self._close_open({"p"}, CONTAINERS | DROPPED | {"li", "blockquote", "dd", "th", "figure", "details"})
            if tag in _ENDS:
                self._close_open(*_ENDS[tag])
        elif tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        known = dict(attrs)
        out, names = dropped(tag, known), doubtful(tag, known)
        container = doubt = -1
        if names and not out and not self.skipping:
            if tag in INLINE:
                out = True
            else:
                doubt = len(self.doubtful)
                self.doubtful.append([len(self.blocks), 0, any(map(_READERS.search, names))])
        if not out and not self.skipping and tag in CONTAINERS:
            classes = sorted(re.sub(r"\d+", "#", name) for name in (known.get("class") or "").lower().split())
            parent = self.inside[-1]
            path = xxhash.xxh64_hexdigest(f"{self.containers[parent]['path']}>{'.'.join([tag, *classes])}")
            container = len(self.containers)
            self.containers.append({"tag": tag, "path": path, "first": len(self.blocks), "last": 0, "parent": parent})
            self.inside.append(container)
        if out:
            self.skipping += 1
        self.stack.append((tag, container, out, doubt))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_data(" ")
        elif tag == "p" and self.open["p"] <= 0:
            self._flush()
        elif self.open[tag] > 0:
            self._close_open({tag}, CONTAINERS if tag in INLINE else set())

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.text.append(data)
            if self.open["a"] > 0:
                self.linked += len(data)

    def chain(self) -> list[tuple[int, int | None]]:
        """Containers from the article's element down to the smallest one that holds most of its text.

        With each the hash of what going down to it would leave out, None if that is links only.
        """
        sums = self._sums()
        size = [sums[c["last"]] - sums[c["first"]] for c in self.containers]
        at = max((i for i, c in enumerate(self.containers) if c["tag"] in SEMANTIC and size[i]), key=lambda i: (size[i], i), default=0)
        largest: dict[int, int] = {}
        for i, c in enumerate(self.containers[1:], 1):
            if size[i] > size[largest.get(c["parent"], i)] or c["parent"] not in largest:
                largest[c["parent"]] = i
        found: list[tuple[int, int | None]] = [(at, None)]
        while self.containers[at]["tag"] != "article" and at in largest and size[largest[at]] > 0 and size[largest[at]] >= BULK * size[at]:
            outer, inner = self.containers[at], self.containers[largest[at]]
            beside = [*range(outer["first"], inner["first"]), *range(inner["last"], outer["last"])]
            text = [i for i in beside if not self.gone[i] and self.plain[i] > (1 - LINKED) * len(self.blocks[i])]
            left = xxhash.xxh64_intdigest("\n".join(self.blocks[i] for i in text)) - (1 << 63) if text else None
            at = largest[at]
            found.append((at, left))
        return found

    def main_text(self, path: str) -> str:
        """Blocks of the containers on a path, in page order."""
        blocks, end = [], 0
        for c in self.containers:
            if c["path"] == path and c["first"] >= end:
                blocks += [self.blocks[i] for i in range(c["first"], c["last"]) if not self.gone[i]]
                end = max(end, c["last"])
        return "\n".join(blocks)


def _paths(pages: DataFrame) -> DataFrame:
    """(host, k1, k2, path, depth, beside): the paths of every page, and the place and the left-out text of those it proposes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, depths, beside = [], [], [], []
            for row, html in enumerate(batch.column("html")):
                page = Page(html.as_py())
                proposed: dict = {}
                for depth, (i, left) in enumerate(page.chain()):
                    proposed.setdefault(page.containers[i]["path"], (depth, left))
                own = {c["path"] for c in page.containers if not all(page.gone[c["first"] : c["last"]]) or c["path"] in proposed}
                rows += [row] * len(own)
                paths += own
                depths += [proposed.get(path, (None, None))[0] for path in own]
                beside += [proposed.get(path, (None, None))[1] for path in own]
            index = pa.array(rows, pa.int64())
            arrays = [batch.column(c).take(index) for c in ("host", "k1", "k2")]
            arrays += [pa.array(paths, pa.string()), pa.array(depths, pa.int32()), pa.array(beside, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "k1", "k2", "path", "depth", "beside"])

    return pages.mapInArrow(read, "host string, k1 long, k2 long, path string, depth int, beside long")


def _choices(paths: DataFrame) -> DataFrame:
    """(k1, k2, end): the place down to which each page may go.

    Text beside a container may be left out where at least half of the host's pages that would go down to that path,
    and two of them, have the same text there.
    """
    steps = paths.where("depth IS NOT NULL")
    texts = steps.groupBy("host", "path", "beside").agg(F.count("*").alias("n"))
    pages = texts.groupBy("host", "path").agg(F.sum("n").alias("pages"))
    repeated = texts.where("beside IS NOT NULL AND n > 1").join(pages, ["host", "path"]).where("2 * n >= pages")
    judged = steps.join(repeated.select("host", "path", "beside", "n"), ["host", "path", "beside"], "left")
    stopped = F.min(F.when(F.col("beside").isNotNull() & F.col("n").isNull(), F.col("depth") - 1))
    return judged.groupBy("k1", "k2").agg(F.coalesce(stopped, F.max("depth")).alias("end"))


def _extract(pages: DataFrame, kinds: list) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h.as_py()).main_text(p.as_py()) for h, p in zip(batch.column("html"), batch.column("path"))]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "url", "text", "n_chars"])

    id_kind, url_kind = (k.dataType.simpleString() for k in kinds)
    return pages.select("id", "url", "html", "path").mapInArrow(read, f"id {id_kind}, url {url_kind}, text string, n_chars long")


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every row of ``pages``.

    Blocks of the main text are joined by a line break, white space inside a block is one space,
    character references are decoded. Null pages count as empty and have an empty text. Null
    addresses form one host. Repeated rows give repeated rows and vote once. No rows give no
    rows. Other columns are not read.
    """
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    content = F.coalesce(F.col(html), F.lit(""))
    known = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), host.alias("host"), content.alias("html"))
    known = known.withColumn("k1", F.xxhash64("host", "html")).withColumn("k2", F.xxhash64(F.lit(1), "host", "html"))
    paths = cut_lineage(_paths(known.select("host", "k1", "k2", "html"))).distinct()
    paths = paths.join(_choices(paths), ["k1", "k2"])
    paths = paths.withColumn("chosen", (F.coalesce("depth", F.lit(-1)) == F.col("end")).cast("long"))
    votes = paths.groupBy("host", "path").agg((F.sum("chosen") / (F.count("*") + 1)).alias("share"), F.sum("chosen").alias("votes"))
    scored = paths.join(votes.where("votes > 0"), ["host", "path"])
    best = scored.groupBy("k1", "k2").agg(F.max(F.struct("share", "votes", "chosen", "path")).alias("best"))
    joined = known.join(best.select("k1", "k2", "best.path"), ["k1", "k2"])
    found = _extract(joined, [pages.schema[id], pages.schema[url]])
    return found.withColumnsRenamed({"id": id, "url": url})
