"""Main text of web pages with the site's template removed.

Element subtrees of a page are hashed; Spark counts beside how many other contents of a host each hash occurs.  Subtrees
that recur over many pages of their host are its template and go, as do elements that say themselves what they are
(menus, footers, adverts, forms, ...).  What an <article> (or else <main>) holds is the page's own: what stands around
it is never template, and inside it only containers can be, never paragraphs or headings, since authors do repeat
themselves, nor what holds all of its text.

Copies of a page tell nothing about the site: a subtree counts once for all pages whose remaining text is the same.
Inside an article it counts once for all of those that also have one path, so variants of a URL count once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, salted_join
from ..session import stored
from .common import slices, tuned
from .url_rules import host_and_path

MIN_PAGES = 3
MIN_SHARE = 0.1
CHUNK_BYTES = 1 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("aside center dl div figure footer form header nav ol section table ul".split())
CLOSED_BY_SAME = frozenset("dd dt li option p td th tr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
# Elements and marks of what is not the page's text.
DROPPED = frozenset("aside button canvas dialog footer form head iframe input nav noscript object select svg template textarea title".split())
DROPPED_OUTSIDE = DROPPED | {"header"}
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer menu modal nav navbar "
    "navigation newsletter notice notices pagination pager popup promo promoted related share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar".split()
)

RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?][^>]*>|<[a-zA-Z/!?][^>]*\Z")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "start", "end", "parent", "dropped", "own", "holds")

    def __init__(self, tag: str, start: int, parent: "Element | None", dropped: bool, own: bool):
        """dropped: as the element itself says; Page adds what the elements around it say."""
        self.tag, self.start, self.end, self.parent, self.dropped, self.own = tag, start, -1, parent, dropped, own
        self.holds = False  # an <article> or <main> that is not dropped itself
        if tag in ("article", "main") and not dropped:
            while parent is not None and not parent.holds:
                parent.holds, parent = True, parent.parent


def says_so(tag: str, attributes: str, inside: bool) -> bool:
    """Does the element itself say that it is not main text?"""
    if tag in (DROPPED if inside else DROPPED_OUTSIDE):
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in DROPPED_ROLES:
                return True
        elif not DROPPED_WORDS.isdisjoint(WORD.findall(value)):
            return True
    return False


class Page:
    """A page cut into elements and pieces of text, each piece with its innermost element."""

    def __init__(self, source: str):
        self.source = source = RAW.sub(" ", source)
        self.elements: list[Element] = []
        self.pieces: list[tuple[str, Element | None]] = []
        top: Element | None = None
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self.pieces.append((source[at : m.start()], top))
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag not in INLINE:
                self.pieces.append((" ", top))
            if m[1]:
                top = self._close(tag, top, m)
            else:
                if tag in CLOSES_P or tag in CLOSED_BY_SAME:
                    top = self._implied(tag, top, m.start())
                own = tag in ("article", "main") or top is not None and top.own
                dropped = says_so(tag, m[3], own and tag not in ("article", "main"))
                if tag not in VOID and not m[3].endswith("/"):
                    top = Element(tag, m.start(), top, dropped, own)
                    self.elements.append(top)
        if at < len(source):
            self.pieces.append((source[at:], top))
        for e in self.elements:  # parents come first
            if e.end < 0:
                e.end = len(source)
            # Whatever it is called, what holds an article goes on as a frame around it.
            e.dropped = e.dropped and not e.holds or e.parent is not None and e.parent.dropped

    def _close(self, tag: str, top: Element | None, m: re.Match) -> Element | None:
        e = top
        while e is not None and e.tag != tag:
            e = e.parent
        if e is None:
            return top
        while top is not e:
            top.end = m.start()
            top = top.parent
        e.end = m.end()
        return e.parent

    @staticmethod
    def _implied(tag: str, top: Element | None, at: int) -> Element | None:
        """End an open paragraph, or an item of the same kind, that a start tag ends."""
        ended = {tag} if tag in CLOSED_BY_SAME else set()
        if tag in CLOSES_P:
            ended.add("p")
        e = top
        while e is not None and (e.tag in INLINE or e.tag in ended):
            if e.tag in ended:
                while top is not e:
                    top.end = at
                    top = top.parent
                e.end = at
                return e.parent
            e = e.parent
        return top

    def subtrees(self) -> dict[int, list[Element]]:
        """Hash (signed) of every subtree that can be template, with the elements that have it."""
        out: dict[int, list[Element]] = {}
        for e in self.elements:
            if e.tag in ("html", "body", "article", "main", "head") or e.holds or e.own and e.tag not in CONTAINERS:
                continue
            raw = xxhash.xxh64_intdigest(" ".join(self.source[e.start : e.end].split()).encode())
            out.setdefault(raw - (1 << 64) if raw >> 63 else raw, []).append(e)
        return out

    def sums(self) -> tuple[int, dict[int, int]]:
        """Sum of the hashes of the page's pieces of text, and of those in each element (by id()); dropped ones are 0."""
        each = {id(e): 0 for e in self.elements}
        total = 0
        for t, e in self.pieces:
            words = t.split()
            if words and (e is None or not e.dropped):
                value = xxhash.xxh64_intdigest(" ".join(words).encode())
                total += value
                if e is not None:
                    each[id(e)] += value
        for e in reversed(self.elements):  # children come last
            if e.parent is not None:
                each[id(e.parent)] += each[id(e)]
        return total, each

    def counted(self) -> tuple[int, list[tuple[int, int, bool]]]:
        """Hash (signed) of the page's text; of every subtree the hash, that of the text around it and whether an article holds it."""
        total, each = self.sums()
        signed = lambda n: (n + (1 << 63)) % (1 << 64) - (1 << 63)
        return signed(total), [(h, signed(total - sum(each[id(e)] for e in found)), any(e.own for e in found)) for h, found in self.subtrees().items()]

    def text(self, template: set[int]) -> str:
        gone = {id(e) for h, found in self.subtrees().items() if h in template for e in found} if template else set()
        if gone:
            each = self.sums()[1]
            whole: dict[int, int] = {}  # text of the outermost article around each element
            for e in self.elements:
                if e.own:
                    whole[id(e)] = whole[id(e.parent)] if e.parent is not None and e.parent.own else each[id(e)]
                    if each[id(e)] and each[id(e)] == whole[id(e)]:
                        gone.discard(id(e))
        state: dict[int, bool] = {}
        for e in self.elements:  # parents come first
            state[id(e)] = not (e.dropped or id(e) in gone or e.parent is not None and not state[id(e.parent)])
        for root in ("article", "main", None):
            if root is None or any(e.tag == root and state[id(e)] for e in self.elements):
                break
        inside: dict[int, bool] = {}
        for e in self.elements:
            inside[id(e)] = root is None or e.tag == root or e.parent is not None and inside[id(e.parent)]
        parts = [t for t, e in self.pieces if (root is None if e is None else state[id(e)] and inside[id(e)])]
        return " ".join(html.unescape("".join(parts)).split())


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", CHUNK_BYTES):
        found = [Page(t).counted() if t else (0, []) for t in batch.column("html").to_pylist()]
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("rest", pa.int64()), ("own", pa.bool_())]))
        subtrees = pa.array([[dict(zip(("hash", "rest", "own"), x)) for x in page] for _, page in found], kind)
        columns = [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array([total for total, _ in found], pa.int64()), subtrees]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "content", "subtrees"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", CHUNK_BYTES):
        text = [Page(t).text(set(h or ())) if t else "" for t, h in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def template_subtrees(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, hash: the template subtrees of each host of (page_id, host, path, html)."""
    schema = "page_id bigint, host string, path string, content bigint, subtrees array<struct<hash: bigint, rest: bigint, own: boolean>>"
    found = pages.select("page_id", "host", "path", "html").mapInArrow(_hashes, schema)
    each = found.select("page_id", "host", "path", F.explode("subtrees").alias("s")).select("page_id", "host", "path", "s.*")
    # Distinct first, then counted: both sum up in every task before their shuffle.
    sizes = found.select("host", "content", "path").distinct().groupBy("host").agg(F.count_distinct("content").alias("contents"), F.count("*").alias("pages"))
    where = F.when(F.col("own"), F.col("path")).otherwise("")
    counts = each.select("host", "hash", "own", "rest", where.alias("path")).distinct().groupBy("host", "hash", "own").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    # A host has few template subtrees, so the hot host is not hot here.
    most = F.when(F.col("own"), F.col("pages")).otherwise(F.col("contents"))
    template = counts.join(sizes, "host").where(F.col("n") >= min_share * most).select("host", "hash").distinct()
    return template


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each row of pages.

    Null or empty html gives an empty text; a page cut off in the middle keeps what it has; a null URL belongs to the
    host ''.  Rows that repeat a page_id are extracted one by one; recurring means beside min_pages distinct contents and
    min_share of the host's distinct contents (inside an article: of contents and paths).  An empty table gives an empty one; other columns are ignored.
    """
    tuned(pages.sparkSession)
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"), path.alias("path"))
    template = stored(template_subtrees(rows, min_pages, min_share))
    hosts = template.groupBy("host").agg(F.collect_list("hash").alias("template"))
    # The pages stay where they are read as long as all hosts' template subtrees measure small.
    joined = rows.join(F.broadcast(hosts), "host", "left") if fits_broadcast(template) else salted_join(rows, hosts, "host", ["page_id", "url"], "left")
    return joined.select("page_id", "url", "html", "template").mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint")
