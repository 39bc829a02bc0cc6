"""Main text of web pages by site template removal.

Every element's subtree (tag, class, id and content) is hashed while a page is read. Spark counts on how many
pages of a host each hash occurs; subtrees that recur on many pages of a host are that site's template
(menus, notices, teasers, whatever their markup), and they are deleted when the page is read for its text.

What counting cannot see, because a host has few pages or because a part differs from page to page, is told by
its role: elements that never hold prose (scripts, forms, navigation, ...) and elements whose class, id or role
names them (sidebar, advert, comments, ...) go as well. Of what is left, `article` and `main` elements
are the text if a page has any, else the whole body.

Only hashes are moved to be counted, combined before the shuffle, so a part that a third of all pages share is one row per map
task. Pages meet the list of their own template parts by host and content digest, one list per distinct page.

Defined results
---------------
* Null, empty and wholly unreadable pages give an empty text. Nothing is cut off; pages of any length and depth are read whole.
* A subtree is template when it is on at least `min_pages` distinct pages of its host and on at least `share` per cent of
  them. Pages that are equal to the byte count once, so copies of one page make no template. Pages without a host are one site.
* Where template removal would leave a page without any text, it is not applied to that page.
* A character reference is decoded once. Blocks end at block elements and line breaks; inside a block every
  run of white space is one blank, blocks are joined by one blank, blank ones are left out.
* Rows are judged on their own: null and repeated ids, and repeated rows, all stay. Empty tables give empty
  results. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

MIN_PAGES = 5
SHARE = 50  # per cent of a host's distinct pages

# Kinds of elements. INLINE ones do not end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
# These leave no gap in the text around them.
UNSEEN = frozenset("script style template".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript head template svg math form nav aside footer menu dialog "
    "button select option input object embed applet audio video canvas map datalist fieldset".split())
CONTENT = frozenset(("article", "main"))
WRAPS = frozenset(("form", "fieldset"))
# A start tag of the first kind ends an open element of the second, if no element of the third stands between.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
HOLDS = frozenset("ul ol dl table select html body article main section div aside nav footer header form blockquote td th".split())
# Words in class, id and role that name a part of a page which is not its text.
ROLES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice banner popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended pagination pager toolbar widget skip complementary contentinfo".split())
# Inside the text a header is its own, and a page may call any of its outer boxes after a part it has.
OUTSIDE_ROLES = frozenset(("header", "masthead", "topbar"))
COMMENT_ROLES = frozenset("comment comments commentlist disqus discussion replies reply respond".split())
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAMED = re.compile(r"(?:class|id|role)\s*=", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_END_OF_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
BREAK = "\n"


class _Open:
    """An element that is still open."""

    __slots__ = ("tag", "start", "parts", "drop", "firm", "content", "text", "prose")

    def __init__(self, tag: str, start: int, names: str = "", drop: bool = False, firm: bool = False, content: bool = False):
        self.tag, self.start, self.drop, self.firm, self.content = tag, start, drop, firm, content
        self.parts = [f"<{tag} {names}>"]  # what its digest is made of
        self.text = False  # whether it holds any text that is not blank
        self.prose = False  # whether an article or main lies inside


def _role_words(attributes: str) -> tuple[str, frozenset[str]]:
    """(the names as written, their words in lower case)."""
    values = [b or c or d for _, b, c, d in _NAMES.findall(attributes)]
    if not values:
        return "", frozenset()
    text = " ".join(values)
    return text, frozenset(_WORDS.findall(_CAMEL.sub(" ", unescape(text)).lower()))


class PageReader:
    """Reads one page: the digests of its subtrees, and its text without those in `template`."""

    def __init__(self, template: frozenset[int] = frozenset(), digests: bool = False):
        self.template = template
        self.hashing = digests or bool(template)
        self.digests: set[int] = set()
        self.out: list[str] = []
        self.ranges: list[tuple[int, int]] = []  # of `out` that hold the text of articles
        self.open: list[_Open] = []
        self.depth: dict[str, int] = {}
        self.inside = 0  # open articles
        self.within: dict[str, int] | None = None  # elements begun inside one that goes whole: they are only counted

    def read(self, markup: str) -> "PageReader":
        at, end, match = 0, len(markup), _TOKEN.match
        self.open.append(_Open("", 0))
        while at < end:
            found = match(markup, at)
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                data = found[0]
                if data[0] != "<" or len(data) == 1:
                    self._data(data)
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
                continue
            raw = tag in RAW
            if self.within is not None and not raw:
                if tag not in VOID:
                    self.within[tag] = self.within.get(tag, 0) + 1
                if self.hashing:
                    self.open[-1].parts.append(tag)
                continue
            named = _NAMED.search(attributes)
            if tag in INLINE and not named and not self.depth.get(tag):
                # Nothing can come of it but its place in the digest and, for a line break, the end of a block.
                if self.hashing:
                    self.open[-1].parts.append(tag)
                continue
            self._start(tag, attributes, bool(named))
            if tag in VOID:
                self._close()
            elif raw:
                close = _END_OF_RAW[tag].search(markup, at)
                stop = close.start() if close else end
                if self.hashing:
                    self.open[-1].parts.append(markup[at:stop])
                at = stop
        while self.open:
            self._close()
        return self

    def _data(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        top = self.open[-1]
        self.out.append(text)
        if text.isspace():
            return
        if self.hashing:
            top.parts.append(" ".join(text.split()))
        top.text = True

    def _start(self, tag: str, attributes: str, named: bool) -> None:
        if tag in ENDS_PARAGRAPH and self.depth.get("p"):
            self._end("p")
        elif tag in ENDS:
            self._end_open(ENDS[tag])
        names, words = _role_words(attributes) if named else ("", frozenset())
        content = tag in CONTENT or ("itemprop" in attributes and "articlebody" in attributes.lower())
        comments = not COMMENT_ROLES.isdisjoint(words)
        drop = tag in NEVER or comments or not ROLES.isdisjoint(words)
        if not drop and not self.inside:
            drop = tag == "header" or not OUTSIDE_ROLES.isdisjoint(words)
        if tag in ("html", "body") or (content and not comments):
            drop = False
        if tag not in INLINE and tag not in UNSEEN:
            self.out.append(BREAK)
        # A box named after a part of the page, or a form around it, may hold its text; these never do.
        firm = comments or tag == "header" or (tag in NEVER and tag not in WRAPS)
        frame = _Open(tag, len(self.out), names, drop, firm, content and not comments)
        self.inside += frame.content
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.open.append(frame)
        if drop and firm and self.within is None and tag not in VOID and tag not in RAW:
            self.within = {}

    def _end_open(self, tags: tuple[str, ...]) -> None:
        """End the open elements named `tags` down to the box they are in."""
        while True:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in tags:
                    break
                if self.open[k].tag in HOLDS:
                    return
            else:
                return
            while len(self.open) > k:
                self._close()

    def _end(self, tag: str) -> None:
        """Close back to the nearest open namesake; an inline one is only looked for inside its block."""
        if self.within and self.within.get(tag):
            self.within[tag] -= 1
            return
        if tag in VOID or not self.depth.get(tag):
            if tag in ("br", "p"):
                self.out.append(BREAK)
            return
        if tag in INLINE or tag == "p":
            for frame in reversed(self.open):
                if frame.tag == tag:
                    break
                if frame.tag not in INLINE and (tag != "p" or frame.tag in HOLDS):
                    return
        while self._close() != tag:
            pass

    def _close(self) -> str:
        frame = self.open.pop()
        if not frame.tag:
            return ""
        self.depth[frame.tag] -= 1
        self.inside -= frame.content
        block = frame.tag not in INLINE
        gone = frame.drop and (frame.firm or not frame.prose)
        if frame.drop and frame.firm and frame.tag not in RAW:
            self.within = None
        digest = 0
        if self.hashing and (frame.text or frame.tag in RAW):
            digest = xxhash.xxh3_64_intdigest("\0".join(frame.parts).encode("utf-8", "surrogatepass"))
            if block and frame.text and frame.tag not in ("html", "body"):
                signed = digest - (1 << 64) if digest >> 63 else digest
                self.digests.add(signed)
                gone = gone or signed in self.template
        if gone:
            del self.out[frame.start :]
            while self.ranges and self.ranges[-1][1] > frame.start:
                self.ranges.pop()
        elif frame.content and not self.inside and frame.text:
            self.ranges.append((frame.start, len(self.out)))
        if block and frame.tag not in UNSEEN:
            self.out.append(BREAK)
        if self.open:
            above = self.open[-1]
            if frame.text:
                above.text = True
                if self.hashing:
                    above.parts.append(f"{digest:x}")
            above.prose |= (frame.prose or frame.content) and not gone
        return frame.tag

    def text(self) -> str:
        spans = self.ranges or [(0, len(self.out))]
        # Blocks and runs inside them are set apart by white space alone, so one split serves both.
        return " ".join(" ".join("".join(self.out[a:b]) for a, b in spans).split())


def subtree_digests(markup: str | None) -> list[int]:
    """The digests of the block elements of a page that hold text."""
    return sorted(PageReader(digests=True).read(markup).digests) if markup else []


def main_text(markup: str | None, template: frozenset[int] = frozenset()) -> str:
    """The text of a page without the subtrees in `template`."""
    if not markup:
        return ""
    found = PageReader(template).read(markup).text()
    return found if found or not template else PageReader().read(markup).text()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [subtree_digests(m.as_py()) for m in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("site"), batch.column("page"), pa.array(lists, pa.list_(pa.int64()))], ["site", "page", "parts"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(m.as_py(), frozenset(t.as_py() or ())) for m, t in zip(batch.column("html"), batch.column("template"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])


def host_of(url: Column) -> Column:
    """What stands between `://` and the path, A-Z in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def template_parts(parts: DataFrame, min_pages: int = MIN_PAGES, share: int = SHARE) -> DataFrame:
    """(site, part) of the parts that recur; `parts` has (site, page, parts), one row per distinct page."""
    counts = parts.select("site", F.explode("parts").alias("part")).groupBy("site", "part").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("site").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    return counts.where(F.col("n") >= min_pages).join(sizes, "site").where(F.col("n") * 100 >= F.col("n_pages") * share).select("site", "part")


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
                 share: int = SHARE) -> DataFrame:
    """One row per page: `key`, url, text."""
    # 128 bits of a page tell its copies; host and page are digests, so that nothing long is moved for counting.
    rows = pages.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url"), F.xxhash64(host_of(F.col(f"`{url}`"))).alias("site"),
        F.unhex(F.md5(F.coalesce(F.col(f"`{html}`"), F.lit("")))).alias("page"), F.col(f"`{html}`").alias("html"))
    id_type = rows.schema["id"].dataType.simpleString()
    read = rows.where(F.col("html") != "").select("site", "page", "html").mapInArrow(_digests, "site bigint, page binary, parts array<bigint>")
    # Copies of a page have the same parts: any of their rows stands for them.
    parts = staged(read.groupBy("site", "page").agg(F.max("parts").alias("parts")), "page-parts")
    template = staged(template_parts(parts, min_pages, share), "templates")
    marked = parts.select("site", "page", F.explode("parts").alias("part")).join(template, ["site", "part"], "left_semi")
    lists = marked.groupBy("site", "page").agg(F.collect_list("part").alias("template"))
    met = rows.join(lists, ["site", "page"], "left").select("id", "url", "html", "template")
    return met.mapInArrow(_texts, f"id {id_type}, url string, text string").withColumnRenamed("id", key)
