"""Periodic runs, HTML extraction and fill-in-middle against brute force, and their defined results."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.llm import components, fill_in_middle, html_extract, minhash, periodic_runs, queries

SF = "/root/testdata/sf0.001"


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


# -- periodic runs --------------------------------------------------------------------------------


def brute_runs(words, least):
    """Every stretch of every period, kept where the period is its smallest."""
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            if i > start and length >= max(least, 2 * q):
                if not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                    found.add((start, length, q))
            i += 1
    return sorted(found)


def brute_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force_on_small_alphabets():
    dice = random.Random(11)
    for _ in range(400):
        texts = []
        for _ in range(dice.randint(0, 4)):
            words = [dice.choice("abc"[: dice.randint(1, 3)]) for _ in range(dice.randint(0, 50))]
            if words and dice.random() < 0.5:
                a = dice.randrange(len(words))
                p = 1 + dice.randrange(len(words) - a)
                words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            texts.append(" ".join(words).encode())
        least = dice.choice([1, 2, 4, 12])
        found, collapsed = periodic_runs.find_runs(texts, least)
        for text, runs, rest in zip(texts, found, collapsed):
            words = text.decode().split()
            assert runs == brute_runs(words, least)
            assert rest.decode() == brute_collapse(words, runs)


def test_runs_of_edge_rows(spark):
    long = " ".join(str(i % 7919) for i in range(200_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n ", "x"), (None, "a " * 12, "x"), (None, "a " * 12, "x"), (5, "a " * 11, "x"),
            (6, "a b " * 12, "x"), (7, long, "x")]
    docs = frame(spark, rows, "doc_id bigint, text string, runs string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect()), key=str)
    want = [(1, [], ""), (2, [], ""), (3, [], ""), (None, [(0, 12, 1)], "a"), (None, [(0, 12, 1)], "a"), (5, [], " ".join("a" * 11)),
            (6, [(0, 12, 1)], "a b"), (7, [(0, 200_000, 7919)], " ".join(str(i) for i in range(7919)))]
    assert got == sorted(want, key=str)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_the_longest_run_is_the_first_of_equals(spark):
    rows = [(1, [(5, 12, 2), (0, 12, 3), (0, 12, 2)]), (2, []), (3, [(0, 12, 1), (9, 14, 7)])]
    runs = frame(spark, rows, "i int, runs array<struct<start:bigint,length:bigint,period:bigint>>")
    best = {r.i: r.best and tuple(r.best) for r in runs.select("i", periodic_runs.longest(F.col("runs")).alias("best")).collect()}
    assert best == {1: (0, 12, 2), 2: None, 3: (9, 14, 7)}


def test_the_runs_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(texts)
    planted = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a, p, planted = (h // 10) % n, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8), planted + 1
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        if n > 700:  # the brute force is quadratic
            words = words if n < 1500 else None
        if words is None:
            continue
        runs, row = brute_runs(words, 12), got[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
    assert planted > 5


# -- HTML -----------------------------------------------------------------------------------------


def texts_of(spark, rows, **options):
    pages = frame(spark, rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract_text(pages, **options).collect()}


@pytest.mark.parametrize("markup, text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a &lt;b&gt; &amp;amp; &am", "a <b> &amp; &am"),
    ("<p>one<p>two<br>three <b>bo</b>ld</p>", "one two three bold"),
    ("<nav>menu</nav><header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>Text</article><footer>f</footer>", "Head Text"),
    ("<div class='ad'>buy</div><div id=sidebar>x</div><div class='story'>Story</div><form><p>name</form>", "Story"),
    ("<main><p>M</p><section class='postComments'><article>me too</article></section></main>", "M"),
    ("<div class='layout has-sidebar'><article>A</article><aside>no</aside></div>", "A"),
    ("<article>A<script>if (a<b) '</p>'</script><style>p{}</style><!-- c > d -->B</article>", "AB"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one two x y"),
    ("<article>a < b and <i>c</article> tail", "a < b and c"), ("<script>never closed <p>x", ""),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("<article>" + "w " * 300_000 + "</article>", ("w " * 300_000).strip()),
    ("<p title='>'>kept</p><p title=\"a'b\">too</p>", "kept too"), ("<b><article>in</b> still</article>", "in still"),
    ("<form id=all><article>A</article><input></form>", "A"),
])
def test_main_text(markup, text):
    assert html_extract.main_text(markup) == text


def test_parts_on_many_pages_of_a_host_go(spark):
    def page(i, extra=""):
        return f"<body><section><a href=/>Home</a> <a href=/n>News</a></section><div>{extra}<p>Story {i} told</p></div><p>All rights with us</p></body>"

    rows = [(i, f"https://A.example/{i}", page(i)) for i in range(6)] + [(10 + i, f"https://b.example/{i}", page(i)) for i in range(4)]
    rows += [(20 + i, f"https://c.example/{i}", page(i, "<p>shared by two</p>" if i < 2 else "")) for i in range(6)]
    got = texts_of(spark, rows)
    assert [got[i] for i in range(6)] == [f"Story {i} told" for i in range(6)]
    # Four pages are too few to tell a template; two of six pages are not most of a host's pages.
    assert got[10] == "Home News Story 0 told All rights with us"
    assert got[20] == "shared by two Story 0 told" and got[25] == "Story 5 told"


def test_pages_that_are_copies_keep_their_text(spark):
    same = "<body><div><p>One page</p><p>copied often</p></div></body>"
    got = texts_of(spark, [(i, "https://a.example/", same) for i in range(9)])
    assert set(got.values()) == {"One page copied often"} and len(got) == 9
    # Different pages around the same text: all of it is template, so none is removed.
    framed = texts_of(spark, [(i, "https://a.example/", f"<body data-x={i}><div id=p{i}><p>Same text</p></div>") for i in range(9)])
    assert set(framed.values()) == {"Same text"}


def test_html_edge_rows(spark):
    rows = [(None, None, "<p>a"), (None, None, "<p>a"), (1, "no host", None), (1, "https://x/", ""), (2, "https://x/", "<p>b")]
    pages = frame(spark, rows, "page_id bigint, url string, html string").withColumns({"site": F.lit(1), "text": F.lit("clash"), "page": F.lit(2)})
    got = sorted(((r.page_id, r.url, r.text) for r in html_extract.extract_text(pages).collect()), key=str)
    assert got == sorted([(None, None, "a"), (None, None, "a"), (1, "no host", ""), (1, "https://x/", ""), (2, "https://x/", "b")], key=str)
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_the_html_query_gives_the_article_of_every_page(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op12_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(pages)
    for page_id, markup in pages.items():
        body = re.search(r"<article>(.*)</article>", markup, re.S)[1]
        body = re.sub(r"</?b>", "", re.sub(r"</?p>|<br>|</?h1>", " ", body))
        assert got[page_id].text == " ".join(html.unescape(body).split())
        assert got[page_id].n_chars == len(got[page_id].text)


# -- fill-in-middle -------------------------------------------------------------------------------


def brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark):
    dice = random.Random(3)
    signs = ["a", "Zz", "é", "語", "😀", " ", "\n", "@", "[", "`", "{", "\x7f", "\u0080", "<P", ">", "0", "\x00"]
    rows = [(i, "".join(dice.choice(signs) for _ in range(dice.randint(0, 60)))) for i in range(400)]
    rows += [(None, "no id at all"), (None, "no id at all"), (500, None), (501, ""), (502, "a <M> b"), (503, "wörd " * 60_000), (504, "x" * 9)]
    docs = frame(spark, [(*r, 0) for r in rows], "doc_id bigint, text string, n int")
    made = fill_in_middle.fill_in_middle(docs).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect()), key=str)
    assert got == sorted([(i, *brute_fill(i, t), t or "") for i, t in rows], key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_a_cut_does_not_depend_on_the_texts_beside_it():
    texts = ["abc déf " * k for k in range(40)]
    draws = [np.arange(40) * 7, np.arange(40) * 5]
    whole = fill_in_middle.cut([t.encode() for t in texts], *draws)
    for k, t in enumerate(texts):
        alone = fill_in_middle.cut([t.encode()], draws[0][k : k + 1], draws[1][k : k + 1])
        assert [x[k] for x in whole] == [x[0] for x in alone]


# -- near duplicates in one hot bucket ------------------------------------------------------------


def brute_components(texts):
    """Smallest id reachable over pairs of whole shingle sets with a Jaccard of 0.75 or more."""
    sets = {}
    for i, text in texts.items():
        words = text.lower().split()
        sets[i] = {" ".join(words[k : k + 5]) for k in range(len(words) - 4)}
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: find(i) for i in ids}


def passage_rows(n_groups):
    """Pairs of near copies that all hold one passage, so that bands of all of them fall together."""
    dice = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(50))
    texts = {}
    for g in range(n_groups):
        own = [f"g{g}w{dice.randrange(10**6)}" for _ in range(dice.randint(8, 30))]
        texts[2 * g] = " ".join(own) + " " + passage
        texts[2 * g + 1] = " ".join(own[: len(own) - dice.randint(0, 4)]) + " " + passage
    return texts


def test_a_hot_passage_hides_no_link(spark):
    texts = passage_rows(90)
    docs = frame(spark, list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    want = brute_components(texts)
    assert got == want and len(set(want.values())) > 40


def test_one_bucket_of_many_members_is_searched_whole(spark):
    """75 links among 150 members of a single bucket, through the keys that `near_duplicates` uses."""
    members = frame(spark, [(1, i) for i in range(150)], "bucket bigint, item bigint")
    verify = lambda pairs: pairs.where("a % 75 = b % 75")
    finer = lambda items: items.select((F.col("item") % 75).alias("bucket"), "item")
    labels = {r.item: r.label for r in components.linked(members, verify, finer).collect()}
    assert labels == {i: i % 75 for i in range(150)}


def test_rows_without_an_id_do_not_meet_each_other(spark):
    texts = passage_rows(10)
    rows = [(None, t) for t in texts.values()] + [(7, t) for t in texts.values()]
    got = minhash.near_duplicates(frame(spark, rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {7}
    assert spark.sql("SHOW TABLES").where("tableName like 'shingles_%'").count() == 0
