"""One parse per page: HTML in, a row of facts out.

`html_facts` is the only place where markup is read. It runs as an Arrow-batched barrier stage and
returns just the facts asked for, so page text never travels further than it has to; every field
chain built on top (see `extract`) is made of Catalyst expressions.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions import repos

# Elements without content, elements whose text is not page text, and elements
# dropped as boilerplate before text is taken.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
NOT_TEXT = frozenset(("script", "style", "template", "rt", "rp"))
BOILERPLATE = frozenset(("script", "style", "nav", "footer", "header", "noscript", "svg"))
KEEPS_SPACE = frozenset(("pre", "textarea"))
# Elements whose start changes how the text behind it is read; the library reads them.
NOT_PLAIN = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
_PLAIN_TAG = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z][a-z0-9:_-]*="[^"&<>]*")*)>')
_PLAIN_ATTRIBUTE = re.compile(r' ([a-z][a-z0-9:_-]*)="([^"]*)"')
REPO_LINK = re.compile(repos.REPO_LINK, re.I)
RUNS = re.compile(r"[ \t]+")
LD_TYPE = "application/ld+json"

# Facts on offer and their types. `ld` holds the fields the chains read, `ld_json` the whole items.
LD_FIELDS = (
    "type", "headline", "name", "description", "title", "org_kind", "org_name",
    "date_published", "date_created", "date_posted",
)
FACTS: dict[str, str] = {
    "metas": "ARRAY<STRUCT<property: STRING, name: STRING, content: STRING>>",
    "ld": f"ARRAY<STRUCT<script_no: INT, {', '.join(f'{f}: STRING' for f in LD_FIELDS)}>>",
    "ld_json": "ARRAY<STRUCT<script_no: INT, item: STRING>>",
    "h1": "STRING",
    "h1_titled": "STRING",
    "title": "STRING",
    "time_datetime": "STRING",
    "hrefs": "ARRAY<STRING>",
    "repo_href": "STRING",
    "raw_repo_url": "STRING",
    "author_links": "ARRAY<STRING>",
    "dateline": "STRING",
    "visible_text": "STRING",
}


class _Span:
    """Text runs seen between an element's start and its end."""

    def __init__(self, base: int) -> None:
        self.base = base  # open elements around it, itself included
        self.pieces: list[str] = []
        self.nested = 0
        self.nested_at_text = 0

    def joined(self) -> str:
        return "".join(p for p in (piece.strip() for piece in self.pieces) if p)

    def only_text(self) -> str | None:
        """The text, if the element holds one run of text (directly or in a chain) and nothing else."""
        if len(self.pieces) == 1 and self.nested == self.nested_at_text:
            return self.pieces[0]
        return None


class PageReader(HTMLParser):
    """Collects facts in document order. An end tag closes back to its nearest open namesake;
    one that was never opened is ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[tuple[str, list[_Span]]] = []
        self.depth: Counter[str] = Counter()
        self.hidden = self.boilerplate = self.verbatim = 0
        self.spans: list[_Span] = []
        self.run: list[str] = []
        self.metas: list[dict] = []
        self.hrefs: list[str] = []
        self.visible: list[str] = []
        self.first: dict[str, _Span] = {}
        self.author_spans: list[_Span] = []
        self.ld_spans: list[_Span] = []
        self.time: str | None = None

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are of no use here and cost a pass over the text."""
        return j

    def parse_starttag(self, i: int) -> int:
        """Plainly written tags are read here in one match, all others by the library, with the same result."""
        found = _PLAIN_TAG.match(self.rawdata, i)
        if found is None or found[1] in NOT_PLAIN:
            return super().parse_starttag(i)
        self.handle_starttag(found[1], _PLAIN_ATTRIBUTE.findall(found[2]))
        return found.end()

    # -- text -------------------------------------------------------------------------------

    def handle_data(self, data: str) -> None:
        self.run.append(data)

    def handle_charref(self, name: str) -> None:
        self.run.append(unescape(f"&#{name};"))

    def handle_entityref(self, name: str) -> None:
        self.run.append(html5.get(f"{name};", f"&{name}"))

    def _break(self, _data: str = "") -> None:
        """Comments and declarations are not text, but they end a run of it."""
        self._end_run()

    handle_comment = handle_decl = handle_pi = _break

    def unknown_decl(self, data: str) -> None:
        self._end_run()
        if data[:6].upper() == "CDATA[":
            self.run.append(data[6:])
            self._end_run()

    def _end_run(self) -> None:
        text = "".join(self.run)
        self.run.clear()
        if not text:
            return
        if not self.verbatim and not text.strip(" \n\t\f\r"):
            text = "\n" if "\n" in text else " "
        if self.hidden:
            tag, readers = self.open[-1]
            readers = readers if tag == "script" else []
        else:
            readers = self.spans
            if not self.boilerplate:
                self.visible.append(text)
        for span in readers:
            span.pieces.append(text)
            span.nested_at_text = len(self.open) - span.base

    # -- elements ---------------------------------------------------------------------------

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_run()
        for span in self.spans:
            span.nested += 1
        opened = self._note(tag, {name: value or "" for name, value in attrs})
        if tag not in VOID:
            self.open.append((tag, opened))
            self.spans.extend(opened)
            self._count(tag, 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self._end_run()
        while self.depth[tag] and self._close_last() != tag:
            pass

    def _count(self, tag: str, step: int) -> None:
        self.depth[tag] += step
        self.hidden += step * (tag in NOT_TEXT)
        self.boilerplate += step * (tag in BOILERPLATE)
        self.verbatim += step * (tag in KEEPS_SPACE)

    def _close_last(self) -> str:
        tag, opened = self.open.pop()
        self._count(tag, -1)
        for span in opened:
            self.spans.remove(span)
        return tag

    def _note(self, tag: str, values: dict[str, str]) -> list[_Span]:
        """Keep the facts an element carries in its attributes; return the spans it opens."""
        opened: list[_Span] = []

        def span(keep: list[_Span] | None = None, fact: str | None = None) -> None:
            new = _Span(len(self.open) + 1)
            if fact is not None:
                if fact in self.first:
                    return
                self.first[fact] = new
            else:
                keep.append(new)
            opened.append(new)

        css = values.get("class", "").lower()
        if tag == "meta":
            self.metas.append({key: values.get(key) for key in ("property", "name", "content")})
        elif tag == "a":
            if "href" in values:
                self.hrefs.append(values["href"])
            if self.first.get("authors") in self.spans:
                span(self.author_spans)
        elif tag == "time":
            if self.time is None:
                self.time = values.get("datetime")
        elif tag == "script":
            if values.get("type") == LD_TYPE:
                span(self.ld_spans)
        elif tag == "div":
            for fact in ("authors", "dateline"):
                if fact in css:
                    span(fact=fact)
        elif tag in ("h1", "title"):
            span(fact=tag)
            if tag == "h1" and "title" in css:
                span(fact="h1_titled")
        return opened


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def _printed(value) -> str | None:
    return str(value) if value else None


def _ld_item(script_no: int, item: dict) -> dict:
    """The fields the chains read; a field of the wrong type counts as absent."""
    org = item.get("hiringOrganization")
    kind = {dict: "object", str: "string"}.get(type(org))
    title = item.get("title")
    if isinstance(title, (int, float)) and title:
        title = str(title)
    return {
        "script_no": script_no,
        "type": _text(item.get("@type")),
        "headline": _text(item.get("headline")),
        "name": _text(item.get("name")),
        "description": _text(item.get("description")),
        "title": _text(title),
        "org_kind": kind,
        "org_name": _text(org.get("name")) if kind == "object" else _text(org),
        "date_published": _printed(item.get("datePublished")),
        "date_created": _printed(item.get("dateCreated")),
        "date_posted": _printed(item.get("datePosted")),
    }


def _ld_items(reader: PageReader) -> Iterator[tuple[int, dict]]:
    """Objects of every script that parses, numbered by script; lists are flattened once."""
    for number, span in enumerate(reader.ld_spans):
        source = span.only_text()
        try:
            value = json.loads(source.strip()) if source else None
        except (ValueError, RecursionError):
            continue
        for item in value if isinstance(value, list) else [value]:
            if isinstance(item, dict):
                yield number, item


def collapse_whitespace(text: str) -> str:
    """One blank for runs of blanks, one empty line for runs of empty lines, trimmed ends."""
    kept: list[str] = []
    for line in text.replace("\xa0", " ").split("\n"):
        if line.strip():
            kept.append(RUNS.sub(" ", line))
        elif kept and kept[-1]:
            kept.append("")
    return "\n".join(kept).strip()


# Elements that can still change a fact; facts of a first element are settled when it has ended.
_FACT_TAGS = {
    "metas": ("meta",), "ld": ("script",), "ld_json": ("script",), "h1": ("h1",), "h1_titled": ("h1",), "title": ("title",),
    "time_datetime": ("time",), "hrefs": ("a",), "repo_href": ("a",), "author_links": ("a", "div"), "dateline": ("div",),
    "raw_repo_url": (),
}
_PIECE = 2048


@lru_cache
def _openings(wanted: tuple[str, ...]) -> re.Pattern | None:
    """Where the elements begin that can change these facts; None where any could."""
    if not all(fact in _FACT_TAGS for fact in wanted):
        return None
    tags = sorted({tag for fact in wanted for tag in _FACT_TAGS[fact]})
    return re.compile(rf"<(?:{'|'.join(tags)})(?![a-z0-9])" if tags else r"(?!)", re.I)


def _last_change(markup: str, wanted: Sequence[str] | None) -> int:
    """Behind this place nothing begins that could change one of the wanted facts; 0 if no such element begins at all."""
    openings = None if wanted is None else _openings(tuple(wanted))
    if openings is None:
        return len(markup)
    last = 0
    for found in openings.finditer(markup):
        last = found.end()
    return last


def read_page(markup: str | None, wanted: Sequence[str] | None = None) -> PageReader | None:
    """The parsed page, or None where the markup cannot be read at all.

    With `wanted` facts, reading ends at the first place after which none of them can change.
    """
    reader = PageReader()
    text = markup or ""
    last = _last_change(text, wanted)
    if not last:  # nothing to read, and facts of a page that cannot be read are the same
        return reader
    try:
        if last < len(text):
            at = 0
            while at < len(text):
                reader.feed(text[at : at + _PIECE])
                at += _PIECE
                # What the reader holds back is not read yet; an element that is still open may take more text.
                if at - len(reader.rawdata) > last and not reader.spans and not reader.cdata_elem:
                    return reader
        else:
            reader.feed(text)
        reader.close()
        reader._end_run()
    except (AssertionError, ValueError):
        return None
    return reader


def visible_text(markup: str | None) -> str:
    """Page text without boilerplate, white space collapsed."""
    if not markup:
        return ""
    if "<" not in markup and "&" not in markup:
        return collapse_whitespace(markup)
    return _text_of(read_page(markup), markup)


def _text_of(reader: PageReader | None, markup: str) -> str:
    if reader is None:
        return collapse_whitespace(re.sub(r"<[^>]+>", " ", markup))
    return collapse_whitespace(" ".join(reader.visible))


def _first_repo_link(texts) -> str | None:
    for text in texts:
        found = REPO_LINK.search(text.strip())
        if found:
            return found.group(0)
    return None


def page_facts(markup: str | None, wanted: Sequence[str]) -> dict:
    """The wanted facts of one page."""
    parsed = read_page(markup, wanted)
    reader = parsed or PageReader()
    first = reader.first
    makers = {
        "metas": lambda: [m for m in reader.metas if m["property"] is not None or m["name"] is not None],
        "ld": lambda: [_ld_item(n, item) for n, item in _ld_items(reader)],
        "ld_json": lambda: [
            {"script_no": n, "item": json.dumps(item, ensure_ascii=False)} for n, item in _ld_items(reader)
        ],
        "h1": lambda: first["h1"].joined() if "h1" in first else None,
        "h1_titled": lambda: first["h1_titled"].joined() if "h1_titled" in first else None,
        "title": lambda: first["title"].only_text() if "title" in first else None,
        "time_datetime": lambda: reader.time,
        "hrefs": lambda: reader.hrefs,
        "repo_href": lambda: _first_repo_link(reader.hrefs),
        "raw_repo_url": lambda: _first_repo_link([markup or ""]),
        "author_links": lambda: [name for name in (s.joined() for s in reader.author_spans) if name],
        "dateline": lambda: "".join(first["dateline"].pieces) if "dateline" in first else None,
        "visible_text": lambda: _text_of(parsed, markup or ""),
    }
    return {fact: makers[fact]() for fact in wanted}


def html_facts(pages: DataFrame, facts: Sequence[str] = tuple(FACTS), html: str = "content") -> DataFrame:
    """Replace the HTML column by the wanted facts, one row per page, other columns kept.

    Select the columns to keep beforehand: column pruning stops at this stage.
    """
    kept = [c for c in pages.columns if c != html]
    passed = pages.select(*kept, html)
    ddl = ", ".join(f"`{fact}` {FACTS[fact]}" for fact in facts)
    fact_schema = _arrow_schema(ddl)
    schema = T.StructType(passed.select(*kept).schema.fields + T.StructType.fromDDL(ddl).fields)
    wanted = tuple(facts)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [page_facts(markup, wanted) for markup in batch.column(html).to_pylist()]
            made = pa.RecordBatch.from_pylist(rows, schema=fact_schema)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + made.columns, names=kept + list(wanted)
            )

    return passed.mapInArrow(parse, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def clean_text(pages: DataFrame, html: str = "content", out: str = "clean_text") -> DataFrame:
    """Page text without boilerplate; null or empty pages give ''."""
    return html_facts(pages, ["visible_text"], html).withColumnRenamed("visible_text", out)


def json_ld_items(facts: DataFrame) -> DataFrame:
    """One row per JSON-LD object: kept columns, script number, position and JSON text."""
    kept = [c for c in facts.columns if c not in FACTS]
    return facts.select(*kept, F.posexplode("ld_json").alias("item_no", "entry")).select(
        *kept, "item_no", "entry.script_no", "entry.item"
    )
