"""HTML main-text extraction by site template removal (operator 3).

Every block-level element subtree is hashed bottom-up (tag, text, child
hashes), and so is its structural place (tags, classes and ordinals from the
root). Spark counts on how many different pages of a host each hash occurs at
each place; a page's subtrees that recur are its template and are deleted:

* on ``min_pages`` different pages or more, at a place of which at least
  ``min_pure`` of the host's pages hold something that recurs (a menu of a
  section, a rotating advert: the place is the site's, whatever the number of
  pages), or
* on ``min_pages`` and on ``min_share`` of all pages of the host, at any place.

Headings, cells and items of a list are never template by themselves, only as
part of a table, list or container that is. Elements that say what they are
(menus, headers, footers, sidebars, adverts, forms, scripts, styles, comments)
are deleted too. Names are hints: a class speaks by its last word (``site-footer``,
``ad-slot``; not ``notice-period``, ``ad-free`` or ``has-sidebar``); words for notices do
so only outside the article, inside it the element must recur; an element that
holds the page's heading and most of its text, or a form that holds most of it,
is layout; and names never take a page's whole text.

Of the rest, the article (or main) elements are the text if there are any,
else the whole body. Inside an article only containers (div, section, lists,
tables) and elements named as notices can be template, not paragraphs: the text
of an article may repeat. Pages with the same main text count once, so copies
of an article don't make it a template.

Cases: null or empty html gives empty text; a null or hostless url takes part
in no counting; truncated pages and stray tags are read as far as they go; a
very long page is one row in memory; repeated rows each come back; an empty
table gives no rows.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, table

# HTML's element classes, and the words that pages use to name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split())
#: An opening tag that ends an open element, and where the search for that one stops.
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
          "tr": ("tr", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
          "option": ("option", {"select"})}
P_STAYS = frozenset("dd dt li td th tr tbody thead tfoot caption option optgroup legend summary figcaption".split())
DROP_TAGS = frozenset("nav footer aside form head button select input label datalist dialog menu svg canvas object "
                      "audio video map search fieldset".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                       "toolbar tablist".split())
#: Forms are deleted unless they are layout.
FORMS = frozenset("form fieldset".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox adunit dfp sponsor sponsored sponsors "
    "cookie cookies consent gdpr newsletter subscribe subscription signup sidebar sidebars sidenav menu menus nav "
    "navbar navigation breadcrumb breadcrumbs pagination pager masthead topbar footer comment comments commentlist "
    "disqus replies".split())
HINT_WORDS = frozenset(
    "promo promos promotion promoted banner banners notice notices notification notifications alert popup modal overlay "
    "widget widgets toolbar copyright respond".split())
HEADER_WORDS = frozenset("header masthead".split())
#: Words after the one that says what an element is, and words that say what it is not.
PART_WORDS = frozenset(
    "container wrapper wrap inner outer box block area list item items slot unit section panel content contents body "
    "row col column left right top bottom main primary secondary tertiary link links title text group holder frame bar "
    "module region zone form thread count meta icon image small large fixed sticky mobile desktop".split())
NOT_WORDS = frozenset("no not non has have with without is hide show free off".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Never template by themselves.
PARTS = HEADINGS | frozenset("html body head article main td th tr tbody thead tfoot caption li dt dd figcaption summary "
                             "legend option".split())
CONTAINERS = frozenset("div section ul ol dl table figure details center".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|itemprop|aria-hidden|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                   re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Elements in document order (a parent before its children) and the text between their tags."""

    def __init__(self, source: str):
        self.tags, self.attrs, self.parent = ["#"], [""], [-1]
        self.items: list[list] = [[]]  # texts and child numbers of each element
        self.flow: list[tuple[int, str | None]] = []  # (element, text), or (element, None) where a block begins or ends
        stack, at = [0], 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            close, name, attrs = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
            if not name:
                continue
            name = name.lower()
            if close:
                self._close(stack, name)
                continue
            if name in BLOCK:
                self._imply(stack, name)
            node = len(self.tags)
            self.tags.append(name)
            self.attrs.append(attrs)
            self.parent.append(stack[-1])
            self.items.append([])
            self.items[stack[-1]].append(node)
            if name in BLOCK:
                self.flow.append((node, None))
            elif name == "br":
                self.flow.append((stack[-1], " "))
            if name not in VOID:
                stack.append(node)
        if at < len(source):
            self._text(stack[-1], source[at:])

    def _text(self, node: int, text: str) -> None:
        text = _html.unescape(text) if "&" in text else text
        self.items[node].append(text)
        self.flow.append((node, text))

    def _close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tags[stack[k]] == name:
                del stack[k:]
                break
        if name in BLOCK:
            self.flow.append((stack[-1], None))

    def _imply(self, stack: list[int], name: str) -> None:
        """End what the opening tag ends: an open p, or an open item of the same list or row."""
        ends, stop = ("p", {"table", "body", "td", "th"}) if name not in P_STAYS else CLOSES.get(name, ("", set()))
        ends = ends.split()
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[k]]
            if tag in ends:
                del stack[k:]
                return
            if tag in stop or (name not in P_STAYS and tag in BLOCK):
                return

    def judge(self) -> None:
        """``gone``: elements that their names rule out; ``main``: those of an article, or of main without one."""
        n = len(self.tags)
        self.said = [self._said(i) for i in range(n)]
        self._sizes()
        self._mark(self.said)
        if self.size[0] and not any(text is not None and text.strip() and not self.gone[i] and self.main[i]
                                    for i, text in self.flow):
            self._mark([None if x in ("name", "hint") else x for x in self.said])

    def _sizes(self) -> None:
        """Text in each subtree, and whether it has the page's first heading."""
        n = len(self.tags)
        self.size, self.titled = [0] * n, [False] * n
        if "h1" in self.tags:
            self.titled[self.tags.index("h1")] = True
        for i in range(n - 1, -1, -1):
            for item in self.items[i]:
                self.size[i] += self.size[item] if isinstance(item, int) else len(item.strip())
            if i:
                self.titled[self.parent[i]] |= self.titled[i]

    def _mark(self, said: list) -> None:
        n = len(self.tags)
        marks = [t == "article" for t in self.tags]
        if not any(marks):
            marks = [t == "main" or x == "main" for t, x in zip(self.tags, said, strict=True)]
        held = [int(m) for m in marks]
        for i in range(n - 1, 0, -1):
            held[self.parent[i]] += held[i]
        gone, inside, art = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p = self.parent[i]
            tag, x = self.tags[i], said[i]
            art[i] = art[p] or (tag == "article" and not gone[p])
            inside[i] = art[i] or inside[p] or ((tag == "main" or x == "main") and not gone[p])
            most = self.size[i] * 2 >= self.size[0]
            rule = (x == "drop" or x == "form" and not most or x == "name" and not (most and self.titled[i])
                    or x == "hint" and not inside[p] and not (most and self.titled[i])
                    or x == "header" and not inside[p])
            # What holds all articles is layout, whatever its name; part of them may be readers' comments.
            gone[i] = gone[p] or (rule and held[i] < max(1, held[0])) or (
                x is None and self._header_part(i, p, said, inside))
        self.gone, self.inside = gone, inside
        chosen = art if any(a and not g for a, g in zip(art, gone, strict=True)) else inside
        self.main = chosen if any(a and not g for a, g in zip(chosen, gone, strict=True)) else [True] * n
        self.landmark = not all(self.main)

    def _header_part(self, i: int, p: int, said: list, inside: list) -> bool:
        """In an article's header only headings are text."""
        return said[p] == "header" and inside[p] and self.tags[i] in BLOCK and self.tags[i] not in (
            *HEADINGS, "div")

    def _said(self, i: int) -> str | None:
        """What an element says it is: drop, form, name, hint, header, main or nothing."""
        tag = self.tags[i]
        if tag in DROP_TAGS:
            return "form" if tag in FORMS else "drop"
        heads: set[str] = {"header"} if tag == "header" else set()
        if self.attrs[i]:
            for name, *value in _ATTR.findall(self.attrs[i]):
                name, v = name.lower(), next((x for x in value if x), "")
                low = v.lower()
                if name == "role" and low in DROP_ROLES or name == "hidden" or name == "aria-hidden" and low == "true":
                    return "drop"
                if name == "style" and _HIDDEN.search(low):
                    return "drop"
                if name == "role" and low == "main" or name == "itemprop" and low == "articlebody":
                    return "main"
                if name in ("class", "id"):
                    heads.update(filter(None, map(head_word, v.split())))
        if tag in ("html", "body", "main"):
            return None
        if heads & DROP_WORDS:
            return "name"
        if heads & HINT_WORDS:
            return "hint"
        return "header" if heads & HEADER_WORDS else None

    def places(self) -> list[bytes]:
        """Hash of each element's tags, classes and ordinals from the root."""
        out, seen = [b""], [{}]
        for i in range(1, len(self.tags)):
            name = self.tags[i]
            if self.attrs[i] and (m := _CLASS.search(self.attrs[i])):
                name += "." + ".".join(sorted(re.sub(r"\d+", "", m[1] or m[2] or m[3] or "").split()))
            k = seen[self.parent[i]].get(name, 0)
            seen[self.parent[i]][name] = k + 1
            out.append(xxhash.xxh64_digest(out[self.parent[i]] + f"{name} {k}".encode()))
            seen.append({})
        return out

    def hashes(self) -> dict[int, tuple[int, int]]:
        """64-bit hashes of subtree and place of each block element that may be template (and has text)."""
        n = len(self.tags)
        own, text = [b""] * n, [False] * n
        for i in range(n - 1, -1, -1):
            x = xxhash.xxh64(self.tags[i])
            for item in self.items[i]:
                if isinstance(item, int):
                    x.update(own[item])
                    text[i] |= text[item]
                elif words := item.split():
                    x.update("\x00" + " ".join(words))
                    text[i] = True
            own[i] = x.digest()
        holds = [False] * n
        for i in range(n - 1, 0, -1):
            holds[i] |= self.landmark and self.main[i]
            if holds[i]:
                holds[self.parent[i]] = True
        # No element of a menu or footer is counted below the one that goes as a whole.
        may = [i for i in range(1, n) if text[i] and self.tags[i] in BLOCK and not self.gone[self.parent[i]]
               and (self.tags[i] in CONTAINERS or self.said[i] == "hint" if self.landmark and self.main[i]
                    else self.tags[i] not in PARTS and not holds[i])]
        place = self.places()
        return {i: (int.from_bytes(own[i], "big", signed=True), int.from_bytes(place[i], "big", signed=True)) for i in may}

    def text(self, template: frozenset[tuple[int, int]] = frozenset()) -> str:
        """Main text, without subtrees whose hash and place are in ``template``."""
        gone = self.gone
        if template:
            gone, h = list(gone), self.hashes()
            for i in range(1, len(gone)):
                gone[i] = gone[i] or gone[self.parent[i]] or h.get(i) in template
        blocks, now = [], []
        for node, text in [*self.flow, (0, None)]:
            if text is None:
                if now and (words := "".join(now).split()):
                    blocks.append(" ".join(words))
                now = []
            elif not gone[node] and self.main[node]:
                now.append(text)
        return "\n".join(blocks)


def head_word(name: str) -> str | None:
    """The word of a class or id that says what the element is: the last one that names no part or position."""
    words = [w.lower() for w in _WORD.findall(name)]
    if not words or NOT_WORDS.intersection(words):
        return None
    while len(words) > 1 and words[-1] in PART_WORDS:
        words.pop()
    return words[-1]


def read(source: str | None) -> Page:
    page = Page(source or "")
    page.judge()
    return page


def host(url):
    """Host of a url column in lower case without user and port; null if there is none."""
    h = F.lower(F.regexp_extract(url.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h != "", h)


def _key(page: str = "page_id"):
    return F.xxhash64("page_id", "url", "html")


def subtree_rows(pages: DataFrame) -> DataFrame:
    """(page, host, hash, place, main) of every countable subtree; keys of page and host, hash of the main text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for key, site, source in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                page = read(source)
                main = xxhash.xxh64_intdigest(page.text()) - (1 << 63)
                rows = [(key, site, h, place, main) for h, place in set(page.hashes().values())]
                for col, v in zip(out, zip(*rows, strict=True), strict=False):
                    col.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["page", "host", "hash", "place", "main"])
    return (pages.select(_key().alias("page"), F.xxhash64(host(F.col("url"))).alias("host"), "html", host(F.col("url")).alias("h"))
            .filter("h is not null and html is not null").drop("h")
            .select("page", "host", "html").mapInArrow(run, "page long, host long, hash long, place long, main long"))


def site_template(rows: DataFrame, min_pages: int, min_share: float, min_pure: float) -> DataFrame:
    """(host, hash, place) that are template."""
    n = F.count(F.lit(1))
    sites = rows.select("host", "main").distinct().groupBy("host").agg(n.alias("all"))
    anywhere = (rows.select("host", "hash", "main").distinct().groupBy("host", "hash").agg(n.alias("n_any"))
                .filter(F.col("n_any") >= min_pages).join(sites, "host").filter(F.col("n_any") >= F.col("all") * min_share)
                .select("host", "hash"))
    at = rows.select("host", "hash", "place", "main").distinct().groupBy("host", "place", "hash").agg(n.alias("n"))
    pure = (at.groupBy("host", "place").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("again"))
            .filter(F.col("again") >= F.col("total") * min_pure).select("host", "place"))
    return (at.filter(F.col("n") >= min_pages).join(pure, ["host", "place"]).select("host", "hash", "place")
            .unionByName(at.join(anywhere, ["host", "hash"]).select("host", "hash", "place")).distinct())


def extract(pages: DataFrame, min_pages: int = 3, min_share: float = 0.5, min_pure: float = 0.5) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, url, text)."""
    scratch = Scratch(pages.sparkSession)
    pages = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    rows, _ = scratch.save(subtree_rows(pages), "subtrees")
    often = site_template(rows, min_pages, min_share, min_pure)
    # A page's own subtrees bound its set.
    template = (rows.join(often, ["host", "hash", "place"]).groupBy("page")
                .agg(F.collect_set(F.array("hash", "place")).alias("template"))
                .withColumnRenamed("page", "tp"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            body = [None if x is None else z.compress(x) for x in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(body, pa.binary()), b.column(3)],
                                             names=["page_id", "url", "body", "page"])

    kind = pages.schema["page_id"].dataType.simpleString()
    # Pages are shuffled to meet their templates: smaller when compressed as whole pages.
    packed = pages.withColumn("page", _key()).mapInArrow(squeeze, f"page_id {kind}, url string, body binary, page long")
    j = packed.join(template, F.col("page") == F.col("tp"), "left").select("page_id", "url", "body", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            text = [read(z.decompress(x).decode()).text(frozenset(map(tuple, t or ()))) if x is not None else ""
                    for x, t in zip(b.column("body").to_pylist(), b.column("template").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string())],
                                             names=["page_id", "url", "text"])
    return j.mapInArrow(run, f"page_id {kind}, url string, text string")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
