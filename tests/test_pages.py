"""HTML facts, field chains and chunks."""

import random
from datetime import datetime
from html.parser import HTMLParser

import pytest

from gleanwork.operators import chunk, extract, html

AS_OF = datetime(2024, 3, 10, 12, 0, 0)
LD = '<script type="application/ld+json">{}</script>'


def facts(markup, *wanted):
    found = html.page_facts(markup, wanted)
    return found[wanted[0]] if len(wanted) == 1 else found


def test_first_heading_and_title():
    page = "<title> A &amp; B </title><h1> One <b>two</b>\n</h1><h1 class='Main-TITLE big'>Three</h1>"
    got = facts(page, "h1", "h1_titled", "title")
    assert got == {"h1": "Onetwo", "h1_titled": "Three", "title": " A & B "}


@pytest.mark.parametrize("page, title", [
    ("<title></title>", None), ("<title>a<b>c</b></title>", None), ("<title><b>c</b></title>", "c"), ("<title>a<br></title>", None),
    ("<p>none", None), ("<title>one</title><title>two</title>", "one"), ("<title>&lt;x&gt; &unknown; &#8364;</title>", "<x> &unknown €"),
])
def test_title_counts_only_as_a_single_text(page, title):
    assert facts(page, "title") == title


def test_end_tags_close_back_to_their_namesake():
    page = "<h1>a<i>b</h1>c</i></div><h1>d</h1>"
    assert facts(page, "h1") == "ab"
    assert html.visible_text("<nav>x<nav>y</nav>z</nav>kept</nav> too") == "kept too"


def test_visible_text():
    page = (
        "<!DOCTYPE html><head><title>T</title><style>p{}</style></head><header>h</header>\n\n\n<p>One&nbsp;<!-- no -->two"
        "<script>var a='</p>';</script></p><noscript>n</noscript><svg><text>s</text></svg><footer>f</footer>\t <pre>a\n \n\nb</pre>"
    )
    assert html.visible_text(page) == "T \n One two a\n\nb"
    assert html.visible_text(None) == html.visible_text("") == ""
    assert html.visible_text("  plain \t text\n\n\n\nmore ") == "plain text\n\nmore"
    assert html.visible_text("a <![CDATA[b]]> c") == "a b c"


def test_links_metas_and_time():
    page = '<meta name=A content="1"><meta property="p"><meta charset=x><a href=" u ">x</a><a>y</a><time>t</time><time datetime="">z</time>'
    got = facts(page, "metas", "hrefs", "time_datetime")
    assert got["metas"] == [{"property": None, "name": "A", "content": "1"}, {"property": "p", "name": None, "content": None}]
    assert got["hrefs"] == [" u "] and got["time_datetime"] == ""


def test_json_ld_items_are_flattened_and_bad_scripts_skipped():
    page = LD.format('[{"name": "a"}, 3, {"name": 4, "datePublished": 20240101}]') + LD.format("{oops") + LD.format('{"@type": "X"}')
    got = facts(page, "ld")
    assert [(i["script_no"], i["type"], i["name"], i["date_published"]) for i in got] == [
        (0, None, "a", None), (0, None, None, "20240101"), (2, "X", None, None)
    ]


def test_json_ld_rows(spark):
    pages = spark.createDataFrame([(1, LD.format('[{"a":1},{"a":2}]')), (2, "<p>")], "id int, content string")
    rows = html.json_ld_items(html.html_facts(pages, ["ld_json"])).orderBy("item_no").collect()
    assert [(r.id, r.item_no, r.script_no, r.item) for r in rows] == [(1, 0, 0, '{"a": 1}'), (1, 1, 0, '{"a": 2}')]


def run(spark, extractor, *pages, **kw):
    rows = spark.createDataFrame([(i, f"https://s/{i}", p) for i, p in enumerate(pages)], "seq int, url string, content string")
    return extractor(rows, AS_OF, keep=("seq",), **kw).orderBy("seq").collect()


def test_papers(spark):
    full = (
        '<meta name="citation_title" content=" Small Nets "><meta name="citation_author" content="Ana"><meta name="citation_author" content="">'
        '<meta name="citation_author" content=" Bo "><meta name="citation_date" content="soon"><meta name="citation_online_date" content="2023/4/5">'
        '<p>https://github.com/raw/first <a href="/x">x</a> <a href="https://github.com/team/toolkit.git#readme">code</a>'
    )
    page = (
        '<title>Title: unused</title><h1 class="title">TITLE:<i> Deep</i> Trees</h1><div class="authors">By <a>Ana</a>, <a> </a><a>Bo <b>X</b></a></div>'
        '<div class="the-dateline">(Submitted on  7 Jun 2023)</div>code: http://github.com/o/r.'
    )
    empty_meta = '<meta name="citation_title" content=""><meta name="citation_title" content="second"><title>title: Plain</title>'
    blank_heading = '<h1 class="title">Title:</h1><title>no</title>'
    got = run(spark, extract.extract_papers, full, page, empty_meta, blank_heading, "", None)
    assert [(r.title, r.authors, r.github_url, r.published_date) for r in got] == [
        ("Small Nets", ["Ana", "Bo"], "https://github.com/team/toolkit", "2023-04-05T00:00:00Z"),
        ("DeepTrees", ["Ana", "BoX"], "https://github.com/o/r.", "2023-06-07T00:00:00Z"),
        ("Plain", [], None, None),
        ("", [], None, None),
        (None, [], None, None),
        (None, [], None, None),
    ]
    assert run(spark, extract.extract_papers, full, compat=True)[0].github_url == "https://github.com/team/toolk"


def test_news(spark):
    pages = [
        '<meta property="og:title" content=" Big &amp; new "><meta property="og:description" content="d"><meta property="article:published_time" content="3 hours ago">',
        LD.format('[{"name":"","datePublished":"?"},{"headline":" H ","description":"S","dateCreated":"2024-03-08T12:00:00Z"}]'),
        '<meta property="og:title" content="  "><h1>no</h1>',
        '<meta property="og:title" content=""><h1> Head <i>ing</i></h1><time datetime="2024-03-09T12:00:00Z">',
        '<meta property="article:published_time" content=""><meta name="article:published_time" content="2024-03-10"><title> T </title>',
        '<meta name="pubdate" content="2024-03-10T13:00:00Z"><meta name="description" content=" m ">' + LD.format('{"headline": 7, "description": 8}'),
        "", None,
    ]
    got = run(spark, extract.extract_news, *pages)
    assert [(r.title, r.content_summary, r.published_date, r.is_fresh) for r in got] == [
        ("Big & new", "d", "2024-03-10T09:00:00Z", True),
        ("H", "S", "2024-03-08T12:00:00Z", False),
        ("Untitled News", None, None, False),
        ("Heading", None, "2024-03-09T12:00:00Z", True),
        ("T", None, None, False),
        ("Untitled News", "m", "2024-03-10T13:00:00Z", False),
        ("Untitled News", None, None, False),
        ("Untitled News", None, None, False),
    ]
    assert got[0].source.asDict() == {"name": "AI News", "url": "https://s/0"}


def test_jobs(spark):
    first = '{"@type":"JobPosting","title":"First","hiringOrganization":{"name":"Org"},"datePosted":"2024-03-10"}'
    pages = [
        LD.format(first),
        LD.format("[" + first.replace("First", " A ") + ',{"@type":"JobPosting","title":"ignored"}]'),
        LD.format(first) + LD.format('{"@type":"JobPosting","hiringOrganization":"Text Org","datePosted":"?"}') + "<h1>H</h1>",
        LD.format(first) + LD.format('{"@type":"JobPosting","title":"Last","hiringOrganization":{}}') + '<meta name="author" content=" Au ">',
        LD.format('{"@type":["JobPosting"],"title":"x"}') + '<meta property="og:title" content="O"><meta property="og:site_name" content="Site">'
        + '<time datetime="soon"></time><meta name="datePosted" content="2024-03-10">',
        '<h1>H</h1><meta name="datePosted" content="2024-03-01">',
        "", None,
    ]
    got = run(spark, extract.extract_jobs, *pages)
    assert [(r.company_name, r.title, r.published_date, r.is_fresh) for r in got] == [
        ("Org", "First", "2024-03-10T00:00:00Z", True),
        ("Org", " A ", "2024-03-10T00:00:00Z", True),
        ("Text Org", "H", None, False),
        ("Au", "Last", "2024-03-10T00:00:00Z", True),
        ("Site", "O", None, False),
        ("Unknown Company", "H", "2024-03-01T00:00:00Z", False),
        ("Unknown Company", "Unknown Title", None, False),
        ("Unknown Company", "Unknown Title", None, False),
    ]


def test_source_name_is_the_callers_or_the_default(spark):
    rows = spark.createDataFrame([("u", "<h1>x", "Mine"), ("v", "<h1>x", None)], "url string, content string, source_name string")
    assert {r.source.name for r in extract.extract_jobs(rows, AS_OF).collect()} == {"Mine", "AI Jobs"}


def test_chunks_cover_the_text_within_bounds():
    words = " ".join(f"Word{i} ends here." if i % 3 else f"line {i}\n" for i in range(400))
    for size, overlap in ((100, 10), (333, 50), (4000, 200)):
        spans = list(chunk.chunk_spans(words, size, overlap))
        assert spans[0][0] == 0 and spans[-1][1] == len(words)
        assert all(0 < stop - start <= size for start, stop in spans)
        assert all(b[0] <= a[1] and b[0] > a[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("text, size, overlap, chunks", [
    ("x" * 10, 10, 2, ["x" * 10]),
    ("x" * 11, 10, 2, ["x" * 10, "xxx"]),
    ("aaaaaa. bbbb", 10, 0, ["aaaaaa.", "bbbb"]),
    ("aa. bbbbbbbbb", 10, 0, ["aa. bbbbbb", "bbb"]),
    ("абвгд. ежз", 8, 3, ["абвгд.", "гд. ежз"]),
    ("abc", 2, 5, ["ab", "bc"]),
    ("<nav>only</nav>", 10, 2, []), ("", 10, 2, []), (None, 10, 2, []),
])
def test_chunk_text(text, size, overlap, chunks):
    assert list(chunk.text_chunks(text, size, overlap)) == chunks


def test_chunk_documents_and_requests(spark):
    docs = spark.createDataFrame([(7, "One. " * 30), (8, "<p></p>"), (9, None)], "doc_id bigint, text string")
    rows = chunk.chunk_documents(docs, 60, 5).orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(len(rows))) and {r.doc_id for r in rows} == {7}
    asked = chunk.extraction_requests(docs, "Sys", 60, 5)
    assert asked.count() == len(rows) and asked.first().system_prompt.startswith("Sys\nIMPORTANT")
    chunk.register_chunk_udtf(spark)
    assert spark.sql("SELECT * FROM chunk_text('aaaaaa. bbbb', 10, 0)").count() == 2


def test_plain_tags_and_pages_without_wanted_ones_read_the_same(monkeypatch):
    rng = random.Random(5)
    parts = ['<meta property="og:title" content="a b">', "<META name=x content='y'>", '<p class="a" class="b">', '<a href="/x">', '<a href="/x?a=1&amp;b=2">', "</a>",
             '<h1 class="Title">', "</h1>", "<title>", "</title>", '<script type="application/ld+json">{"name":"<b>"}', "</script>", "<time datetime=\"z\">", "</time>",
             '<div class="dateline">', "</div>", "text", " ", "&amp;", "<", "<b", '<i x="', '">', "<!-- c -->", "<br/>", "<pre>", "<textarea>", "</p>", "<noscript>", '<b  id="q" >']
    pages = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)] + ["", None]
    wanted = [("ld_json",), ("h1", "title"), ("hrefs",), ("metas", "time_datetime"), tuple(html.FACTS)]
    got = [html.page_facts(p, w) for p in pages for w in wanted]
    reads = []
    monkeypatch.setattr(html.PageReader, "feed", lambda self, data: reads.append(data))
    html.page_facts("<h1>a</h1>" * 9, ("ld_json", "hrefs"))
    assert not reads  # neither a script nor a link: nothing is parsed
    monkeypatch.undo()
    monkeypatch.setattr(html.PageReader, "parse_starttag", HTMLParser.parse_starttag)
    last_change = html._last_change
    monkeypatch.setattr(html, "_last_change", lambda markup, facts: max(last_change(markup, facts), 1))
    assert got == [html.page_facts(p, w) for p in pages for w in wanted]
