"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged into one style tree: a node is a path of tags with their class or id, and has as many
style nodes as there are sequences of children below it. Tags and names of noise decide by themselves (menus, headers,
footers, forms, adverts). The importance of every other branch is made of two entropies over the host's pages:

- of its presentation: how the pages are spread over its sequences of children, 0 where all have one, 1 where each has its own;
- of its content: how they are spread over what the branch says, 0 where all say the same, 1 where no two do.

With l sequences of children, importance is (1 - DAMPING^l) * presentation + DAMPING^l * content. Branches of less than
LEAST_IMPORTANCE, seen on LEAST_PAGES pages or more, are cut from each page, in article and main nodes, too. Text outside
those nodes, on a page that has them, is kept only in branches that were seen on LEAST_PAGES pages or more with
SURE_IMPORTANCE: there the tag has said that it is noise, and the tree has to say the contrary.

Copies of a page on one host are no template: pages with the same text count once, and inside article and main nodes
those with the same text there, whatever is around it.

Defined cases: a null or empty html has the empty text; so has a page with noise alone. Pages without a host are one
host. Broken markup is read to its end: open tags are closed by their parents' ends, and what looks like a tag but never
ends is text. Very long and very deep pages are read in one pass. Branches at a threshold stay. Repeated rows give equal
rows; an empty table gives an empty one; other columns are left aside. Paths are hashes and have no numbers in them.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import stored
from ._batches import slices, strings

LEAST_IMPORTANCE, SURE_IMPORTANCE, LEAST_PAGES, DAMPING = 0.3, 0.7, 4, 0.9
#: Paths to cut that may be broadcast, and the places that a host's pages are dealt to if there are more.
BROADCAST_PATHS, SALTS = 20_000, 64

# Tags by what they do to text.
DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video map nav footer aside form button select textarea input label fieldset dialog menu datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset("article main".split())
NOISE_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing social related recommend recommended recommendations sidebar widget widgets nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments disqus respond replies login signin signup toolbar pagination pager skip".split())
NOISE_ARTICLES = frozenset("comment comments related ad ads advert promo sponsored".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSED_BY_LIKE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
LIKE = {tag: {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}.get(tag, {tag}) for tag in CLOSED_BY_LIKE}

#: Outside quotes a tag holds no other tag's beginning, so that one which never ends costs no more than its own length.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|textarea|title|noscript|iframe|xmp|template)\b[^><]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^><\"']|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,2000}+\"|'[^']{0,2000}+')*+)>|<(/?)([a-zA-Z][^\s/><]*+)([^><]*+)>|<[!?/][^><]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


_MASK = (1 << 64) - 1


class Node:
    """An element that is open while its page is read. kids: the sequence of its children so far."""

    __slots__ = ("content", "dropped", "kids", "path", "start", "tag")

    def __init__(self, tag: str, path: int, dropped: bool, content: bool, start: int):
        self.tag, self.path, self.dropped, self.content, self.start, self.kids = tag, path, dropped, content, start, 0


def _hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little")


@lru_cache(maxsize=1 << 16)
def path_of(above: int, tag: str, name: str) -> int:
    """The name of a path: that of the path above it, the tag, and its class or id."""
    return _hash64(f"{above}/{tag}.{name}")


def signed(x: int) -> int:
    x &= _MASK
    return x - (1 << 64) if x >> 63 else x


def _attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(text)} if text.strip(" /\n\t") else {}


def _says_noise(tag: str, own: dict[str, str], in_content: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_content:
        return True
    if not own:
        return False
    if "hidden" in own or own.get("aria-hidden") == "true" or own.get("role", "").lower() in NOISE_ROLES or _HIDDEN.search(own.get("style", "")):
        return True
    names = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{own.get('class', '')} {own.get('id', '')}").lower())
    if tag == "article":
        return any(n in NOISE_ARTICLES for n in names)
    return tag not in ("html", "body", "main") and not (in_content and tag == "header") and any(n in NOISE_NAMES for n in names)


class Page:
    """Blocks of text with the path of each, and the branches whose importance the style tree decides."""

    def __init__(self, html: str):
        self.blocks: list[tuple[int, str, bool]] = []  # path, text, whether in content
        self.branches: list[tuple[int, bool, int, int, int]] = []  # path, whether in content, first and last block, children
        self.sums: dict[bool, list[tuple[int, int]]] = {True: [(0, 0)], False: [(0, 0)]}  # blocks so far inside and outside content: how many, and the sum of their hashes
        self.has_content = False
        self._open: list[Node] = []
        self._count: Counter[str] = Counter()  # of open elements by tag
        self._text: list[str] = []
        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self._add(html[at : m.start()])
            at = m.end()
            if m[1]:
                continue
            slash, tag, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                self._end(tag)
            else:
                self._start(tag, rest)
        self._add(html[at:])
        self._flush()
        while self._open:
            self._close()

    def _add(self, text: str) -> None:
        if not (self._open and self._open[-1].dropped):
            self._text.append(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html_module.unescape("".join(self._text)).split())
            self._text = []
            if text:
                node = self._open[-1] if self._open else None
                content = bool(node and node.content)
                self.blocks.append((node.path if node else 0, text, content))
                for inside, sums in self.sums.items():
                    n, total = sums[-1]
                    sums.append((n + 1, total + _hash64(text)) if inside == content else (n, total))

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._add(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag not in INLINE:
            self._flush()
            if self._count["p"]:
                for n in reversed(self._open):
                    if n.tag == "p":
                        self._end("p")
                        break
                    if n.tag not in INLINE:
                        break
            if tag in CLOSED_BY_LIKE and any(self._count[x] for x in LIKE[tag]):
                for n in reversed(self._open):
                    if n.tag in CLOSED_BY_LIKE[tag]:
                        break
                    if n.tag in LIKE[tag]:
                        self._end(n.tag)
                        break
        above = self._open[-1] if self._open else None
        in_content = bool(above and above.content)
        own = _attributes(rest)
        dropped = bool(above and above.dropped) or _says_noise(tag, own, in_content)
        content = not dropped and (in_content or tag in CONTENT or own.get("role", "").lower() in ("main", "article") or own.get("itemprop", "").lower() == "articlebody")
        self.has_content |= content
        path = above.path if above else 0
        if tag not in INLINE:
            path = path_of(path, tag, re.sub(r"\d+", "", own.get("id") or (own.get("class") or "").strip().replace(" ", ".")))
            if above and not dropped:
                above.kids = (above.kids * 1099511628211 + path) & _MASK
        if dropped and not (above and above.dropped) and tag not in INLINE:
            self._flush()
        self._open.append(Node(tag, path, dropped, content, len(self.blocks)))
        self._count[tag] += 1
        if rest.endswith("/") and tag in ("svg", "math"):
            self._close()

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if not self._count[tag]:
            return
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k].tag == tag:
                if any(n.tag not in INLINE for n in self._open[k:]):
                    self._flush()
                while len(self._open) > k:
                    self._close()
                return
            if tag in INLINE and self._open[k].tag not in INLINE:
                return

    def _close(self) -> None:
        node = self._open.pop()
        self._count[node.tag] -= 1
        if not node.dropped and node.tag not in INLINE:
            above = self._open[-1] if self._open else None
            if above is not None and above.tag in INLINE:  # children of inline elements belong to the block around them
                above.kids = (above.kids * 1099511628211 + node.path) & _MASK
            if len(self.blocks) > node.start:
                self.branches.append((node.path, node.content, node.start, len(self.blocks), node.kids))

    def said(self) -> dict[tuple[int, bool], tuple[int, int]]:
        """What the blocks of each path say in content nodes (True) and outside them, and its children: sums over the page's repeats of the path."""
        out: dict[tuple[int, bool], tuple[int, int]] = {}
        for path, inside, start, end, kids in self.branches:
            sums = self.sums[inside]
            if sums[end][0] > sums[start][0]:
                said, before = out.get((path, inside), (0, 0))
                out[path, inside] = said + sums[end][1] - sums[start][1], before + kids
        return out

    def whole(self, inside: bool) -> int:
        """What the page says in content nodes, or altogether."""
        return self.sums[True][-1][1] + (0 if inside else self.sums[False][-1][1])

    def texts(self, low: set[tuple[int, bool]], sure: frozenset[tuple[int, bool]] | set[tuple[int, bool]] = frozenset()) -> list[str]:
        """Blocks of the main text. low and sure: (path, whether in content) of little and of sure importance on this host."""
        cut: set[int] = set()
        done = {True: 0, False: 0}
        for path, inside, start, end, _ in sorted(self.branches, key=lambda b: b[2]) if low else ():
            if (path, inside) in low:
                cut.update(i for i in range(max(start, done[inside]), end) if self.blocks[i][2] == inside)
                done[inside] = max(done[inside], end)
        return [text for i, (path, text, content) in enumerate(self.blocks) if i not in cut and (content or not self.has_content or (path, False) in sure)]


def host_of(url: str = "url") -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, inside (content nodes), beside (them, on a page or more), pages, presentation, content and importance of all branches that aren't named as noise. pages: host and html.

    Pages of one host with the same text count once, and so do repeats of a path in a page. Shuffled are hashes alone, with
    map-side sums: a row for each distinct page and path, then for each thing that a path says or looks like, then for each path.
    """
    kinds = {"host": (T.StringType(), pa.string()), "path": (T.LongType(), pa.int64()), "inside": (T.BooleanType(), pa.bool_()), "beside": (T.BooleanType(), pa.bool_()), "page": (T.LongType(), pa.int64()), "content": (T.LongType(), pa.int64()), "kids": (T.LongType(), pa.int64())}
    schema = T.StructType([T.StructField(name, kind) for name, (kind, _) in kinds.items()])

    def branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                rows = []
                for host, html in zip(part.column("host").to_pylist(), strings(part, "html"), strict=True):
                    page = Page(html)
                    whole = {inside: signed(page.whole(inside)) for inside in (True, False)}
                    rows += [(host, signed(path), inside, page.has_content and not inside, whole[inside], signed(said), signed(kids)) for (path, inside), (said, kids) in page.said().items()]
                columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds.values(), strict=True)], names=schema.names)

    node = ["host", "path", "inside"]
    once = pages.select("host", "html").mapInArrow(branches, schema).groupBy(*node, "page").agg(F.min("content").alias("content"), F.min("kids").alias("kids"), F.max("beside").alias("beside"))
    both = once.select(*node, "beside", F.explode(F.array(F.struct(F.lit(True).alias("says"), F.col("content").alias("what")), F.struct(F.lit(False).alias("says"), F.col("kids").alias("what")))).alias("_w")).select(*node, "beside", "_w.*")
    spread = both.groupBy(*node, "says", "what").agg(F.count("*").alias("n"), F.max("beside").alias("beside"))
    of = lambda says, value: F.sum(F.when(F.col("says") == F.lit(says), value))
    sums = spread.groupBy(*node).agg(F.max("beside").alias("beside"), of(True, F.col("n")).alias("pages"), of(True, F.col("n") * F.log("n")).alias("_c"), of(False, F.col("n") * F.log("n")).alias("_p"), of(False, F.lit(1)).alias("_l"))
    entropy = lambda s: F.when(F.col("pages") > 1, 1 - F.col(s) / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    damped = F.pow(F.lit(DAMPING), F.col("_l"))
    rated = sums.select(*node, "beside", "pages", entropy("_p").alias("presentation"), entropy("_c").alias("content"), damped.alias("_d"))
    return rated.select(*node, "beside", "pages", "presentation", "content", ((1 - F.col("_d")) * F.col("presentation") + F.col("_d") * F.col("content")).alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host_of())
    known = style_tree(own).where(F.col("pages") >= LEAST_PAGES)
    low, sure = F.col("importance") < LEAST_IMPORTANCE, F.col("beside") & (F.col("importance") >= SURE_IMPORTANCE)
    low = known.where(low | sure).groupBy("host").agg(F.collect_list(F.struct("path", "inside", low.alias("low"))).alias("low"))
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for html, paths in zip(strings(part, "html"), part.column("low").to_pylist(), strict=True):
                    sets: dict[bool, set] = {True: set(), False: set()}
                    for x in paths or ():
                        sets[x["low"]].add((x["path"] & _MASK, x["inside"]))
                    texts.append("\n".join(Page(html).texts(sets[True], sets[False])))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    low = stored(low)
    if (low.agg(F.sum(F.size("low"))).first()[0] or 0) <= BROADCAST_PATHS:
        joined = own.join(F.broadcast(low), "host", "left")
    else:  # a host may have a third of all pages: its row is dealt to SALTS places
        salted = low.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = own.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "_salt"], "left")
    return joined.select("page_id", "url", "html", "low").mapInArrow(read, schema)
