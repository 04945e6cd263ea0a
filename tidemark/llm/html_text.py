"""Main text of web pages: site templates are found per host and removed."""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.url_filter import host
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES = 3  # pages of a host that must share a subtree outside the article,
SHARE = 0.01  # and this share of the host's pages
INNER_PAGES = 10  # the same for boxes within the article
INNER_SHARE = 0.5

TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = INLINE | {"script", "style", "template", "noscript"}  # no space where they stand
#: Elements that a start tag closes when they are open just above it.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
FENCES = frozenset("ul ol table article section div main body html td th blockquote form nav aside header footer dl".split())
#: Never part of the main text.
DROPPED = frozenset(
    "head script style title textarea xmp iframe noembed noframes noscript template svg math canvas object audio video"
    " nav footer aside select option button dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class or id that mark what is no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " notices notification alert popup modal overlay newsletter subscribe subscription paywall sidebar widget widgets menu nav navbar navigation"
    " breadcrumb breadcrumbs masthead topbar footer comment comments commentlist disqus reply replies respond discussion share sharing social"
    " related recommended recommendations teaser login signin signup search pagination pager toolbar skip hidden".split()
)
HEADS = frozenset(["header"])  # of the site; an article's own header holds its title
CONTENT = frozenset("content article post entry story main".split())


class Node(NamedTuple):
    tag: str
    parent: int
    dropped: bool  # it or what holds it is no main text
    main: bool  # it lies in the main text's element
    marks: str
    never: bool = False  # no main text by its own tag, role, style or the head of its name
    named: bool = False  # a word of its name, or being a form, speaks against it
    head: bool = False  # a header of the site, unless it lies in the main text's element
    holder: bool = False  # an article, a main element or the like


class Page:
    """Elements, texts and subtree hashes of one page."""

    def __init__(self, source: str | None) -> None:
        self.nodes: list[Node] = [Node("", -1, False, False, "")]
        self.texts: list[tuple[int, str]] = []
        self.spots: list[str] = []
        self._read(source or "")
        if not any(n.main for n in self.nodes):
            self._rescue()

    def _rescue(self) -> None:
        """Keep an article that only later words of names, or forms, speak against, if it has most of the page's text.

        Such words tell of the layout (``site has-sidebar``), and such a form is the whole page. The article
        and what holds it stay; all else is judged as before.
        """
        lost = [False] * len(self.nodes)
        for i, n in enumerate(self.nodes):
            lost[i] = n.never or n.parent >= 0 and lost[n.parent]
        sizes = [0] * len(self.nodes)
        for i, text in self.texts:
            sizes[i] += 0 if lost[i] else len("".join(text.split()))
        for i in range(len(self.nodes) - 1, 0, -1):
            sizes[self.nodes[i].parent] += sizes[i]
        best = max((i for i, n in enumerate(self.nodes) if n.holder and not lost[i]), key=lambda i: sizes[i], default=0)
        if not best or 2 * sizes[best] <= sizes[0]:
            return
        kept, at = set(), best
        while at > 0:
            kept.add(at)
            at = self.nodes[at].parent
        for i, n in enumerate(self.nodes[1:], 1):
            above = self.nodes[n.parent]
            main = above.main or i == best
            dropped = above.dropped or n.never or i not in kept and (n.named or n.head and not above.main)
            self.nodes[i] = n._replace(dropped=dropped, main=main and not dropped)

    def _read(self, source: str) -> None:
        stack, at = [0], 0
        while at < len(source):
            found = TAG.search(source, at)
            end = found.start() if found else len(source)
            if end > at:
                self.texts.append((stack[-1], html.unescape(source[at:end])))
            if not found:
                break
            at = found.end()
            name = (found[2] or found[5] or "").lower()
            if not name:
                continue
            if found[1] or found[4]:
                if name in ("p", "br"):
                    self.texts.append((stack[-1], " "))
                self._close(stack, name)
                continue
            self._imply(stack, name)
            if name not in SILENT:
                self.texts.append((stack[-1], " "))
            if name in VOID:
                continue
            stack.append(self._open(stack[-1], name, found[3] or found[6] or ""))
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = close.end() if close else len(source)
                stack.pop()

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if self.nodes[stack[i]].tag == name:
                del stack[i:]
                if name not in SILENT:
                    self.texts.append((stack[-1], " "))
                return
            if self.nodes[stack[i]].tag in FENCES and name in INLINE | {"p"}:
                return

    def _imply(self, stack: list[int], name: str) -> None:
        """Close what a start tag ends: an open paragraph before a block, an item before the next."""
        ends = CLOSES.get(name, set()) | (set() if name in INLINE or name in VOID - {"hr"} else {"p"})
        for i in range(len(stack) - 1, 0, -1):
            tag = self.nodes[stack[i]].tag
            if tag in ends:
                del stack[i:]
                return self._imply(stack, name) if name in CLOSES else None
            if tag in FENCES:
                return None

    def _open(self, parent: int, name: str, written: str) -> int:
        above = self.nodes[parent]
        attributes: dict[str, str] = {}
        for key, *values in ATTRIBUTE.findall(written):
            attributes.setdefault(key.lower(), next((v for v in values if v), ""))
        names = (attributes.get("class", "") + " " + attributes.get("id", "")).lower()
        marks, firm = set(), False
        if not names.isspace():
            # words, and names without what separates their words: side-bar is a sidebar; numbers at the end tell nothing
            whole = [re.sub("[^a-z0-9]+", "", x) for x in names.split()]
            marks = {x.rstrip("0123456789") for x in [*re.split("[^a-z0-9]+", names), *whole]}
            # a name that is such a word or begins with one (comment-body), not one like has-sidebar
            leading = [*whole, *(re.split("[^a-z0-9]+", x)[0] for x in names.split())]
            firm = not MARKS.isdisjoint(x.rstrip("0123456789") for x in leading)
        role = attributes.get("role", "").lower()
        holder = name in ("article", "main") or role == "main" or attributes.get("itemprop") == "articleBody"
        never = name in DROPPED or role in ROLES or "hidden" in attributes
        never = never or bool(re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I))
        whole_page = name in ("html", "body", "main")
        named = name == "form" or not whole_page and not MARKS.isdisjoint(marks)
        never = never or firm and not whole_page
        head = name in HEADS or not HEADS.isdisjoint(marks) and not whole_page and name != "article"
        dropped = above.dropped or never or named or head and not above.main
        main = (above.main or holder) and not dropped
        self.nodes.append(Node(name, parent, dropped, main, " ".join(sorted(filter(None, marks))), never, named, head, holder))
        return len(self.nodes) - 1

    def segments(self) -> list[tuple[list[int], list[int], str]]:
        """Stretches of text that one set of subtrees holds: hashes outside and inside the main text, and the text.

        An article, a main element, or else one named like content, holds the main
        text; without any the whole body is open to the counts of its host.
        """
        inside = [n.main for n in self.nodes]
        if not any(inside):
            for i, n in enumerate(self.nodes):
                own = not n.dropped and n.tag in ("div", "section", "td") and not CONTENT.isdisjoint(n.marks.split())
                inside[i] = own or n.parent >= 0 and inside[n.parent] and not n.dropped
        if any(inside):
            kept = [(i, t) for i, t in self.texts if inside[i]]
        else:
            kept = [(i, t) for i, t in self.texts if not self.nodes[i].dropped]
        hashes = self._hashes({i for i, t in kept if not t.isspace()}, kept)
        found: list[tuple[list[int], list[int], str]] = []
        for i, text in kept:
            outer, inner = [], []
            while i > 0:
                node = self.nodes[i]
                if inside[i]:
                    if node.tag in ("div", "section", "ul", "ol", "dl", "table", "details") and inside[node.parent]:
                        inner.append(hashes[i])
                elif node.tag not in ("html", "body"):
                    outer.append(hashes[i])
                i = node.parent
            text = re.sub(r"\s+", " ", text)
            if found and found[-1][:2] == (outer, inner):
                found[-1] = (outer, inner, found[-1][2] + text)
            else:
                found.append((outer, inner, text))
        return [(outer, inner, re.sub(" +", " ", text)) for outer, inner, text in found]

    def _hashes(self, holders: set[int], kept: list[tuple[int, str]]) -> dict[int, int]:
        """A hash of every subtree with kept text: tags, class words and text, in order."""
        parts: dict[int, list[str]] = {}
        order: list[int] = []
        for i, text in kept:
            words = " ".join(text.split())
            if words:
                parts.setdefault(i, []).append(words)
        for i in sorted(parts, reverse=True):
            order.append(i)
        hashes: dict[int, int] = {}
        children: dict[int, list[int]] = {}
        for i in range(len(self.nodes) - 1, 0, -1):
            node = self.nodes[i]
            if i in parts or i in children:
                below = ",".join(map(str, reversed(children.get(i, []))))
                text = "\n".join(parts.get(i, []))
                hashes[i] = xxhash.xxh64_intdigest(f"{node.tag}|{node.marks}|{below}|{text}".encode("utf-8", "replace"), 7) >> 1
                children.setdefault(node.parent, []).append(hashes[i])
            else:
                hashes[i] = 0
        return hashes


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``key``, ``url``, ``text``, ``n_chars`` (code points) of every row.

    Elements that are no main text by their nature, role or class go at once: menus,
    footers, forms, scripts, comments. Where that leaves no article, one that holds most of
    the text stays whatever the names around it say. Every subtree that is left outside the article, or
    is a box within it, is hashed; the hashes are counted per host over its different
    pages (copies are one), and what recurs on many of them is deleted there. References are
    decoded, white space is one space, blocks are joined by one. Paragraphs of an article
    stay however often they recur. A null or empty page has an empty text; a page without
    host meets no counts; repeated rows and null keys stay; other columns are not read;
    no page gives no row.
    """
    narrow = pages.select(pages[key].alias("key"), pages[url].alias("url"), pages[source].alias("html"))
    narrow = narrow.select("key", "url", host(F.col("url")).alias("host"), "html")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [[{"outer": a, "inner": b, "text": t} for a, b, t in Page(x).segments()] for x in batch.column("html").to_pylist()]
            rows = pa.array(range(row, row + len(found)), pa.int64())
            row += len(found)
            columns = [rows, *(batch.column(c) for c in ("key", "url", "host")), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "key", "url", "host", "segments"])

    longs = pa.list_(pa.int64())
    kind = pa.list_(pa.struct([("outer", longs), ("inner", longs), ("text", pa.string())]))
    schema = (
        T.StructType().add("row", "long").add(T.StructField("key", narrow.schema["key"].dataType)).add("url", "string").add("host", "string")
        .add("segments", T.ArrayType(T.StructType().add("outer", T.ArrayType(T.LongType())).add("inner", T.ArrayType(T.LongType())).add("text", "string")))
    )
    parsed = settle(narrow.mapInArrow(read, schema), "pages")

    def hashes(part: str) -> Column:
        return F.array_distinct(F.flatten(F.transform("segments", lambda s: s[part])))

    seen = F.array_union(
        F.transform(hashes("outer"), lambda h: F.struct(h.alias("hash"), F.lit(False).alias("inner"))),
        F.transform(hashes("inner"), lambda h: F.struct(h.alias("hash"), F.lit(True).alias("inner"))),
    )
    sited = parsed.where("host != ''").withColumn("page", F.xxhash64(F.transform("segments", lambda s: s["text"])))
    subtrees = sited.select("row", "host", "page", F.inline(seen))
    sizes = sited.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    counts = subtrees.drop("row").distinct().groupBy("host", "hash", "inner").agg(F.count("*").alias("n"))
    many = F.when(
        F.col("inner"), (F.col("n") >= INNER_PAGES) & (F.col("n") >= INNER_SHARE * F.col("pages"))
    ).otherwise((F.col("n") >= PAGES) & (F.col("n") >= SHARE * F.col("pages")))
    templates = counts.join(sizes, "host").where(many).select("host", "hash", "inner")
    hits = subtrees.join(templates, ["host", "hash", "inner"]).groupBy("row").agg(F.collect_set("hash").alias("hits"))
    # only pages with a subtree open to the counts are joined with what recurs
    open_ = F.exists("segments", lambda s: (F.size(s["outer"]) > 0) | (F.size(s["inner"]) > 0))
    some = parsed.where(open_).join(hits, "row", "left")
    none = F.array().cast("array<bigint>")
    whole = F.coalesce("hits", none)
    left = F.filter("segments", lambda s: ~F.arrays_overlap(F.concat(s["outer"], s["inner"]), whole))
    both = some.withColumn("segments", left).drop("hits").unionByName(parsed.where(~open_))
    text = F.trim(F.regexp_replace(F.array_join(F.transform("segments", lambda s: s["text"]), ""), " +", " "))
    return both.select(F.col("key").alias(key), F.col("url").alias(url), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
