from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pytest
from hypothesis import given, settings, strategies as st

from gleanwork.functions import dates, names, records, repos, text, urls

AS_OF = datetime(2024, 3, 10, 9, 30, 15)


def test_strip_takes_every_white_space(column):
    values = ["　a b ", "\x1c\t x \n", "plain", "   ", "", None]
    assert column(values, text.py_strip) == [v.strip() if v is not None else None for v in values]


@pytest.mark.parametrize("url, canonical", [
    ("HTTP://Site.Example:8080/Path///", "http://site.example:8080/Path"),
    ("https://site.example/", "https://site.example"),
    ("https://site.example", "https://site.example"),
    ("https://site.example/a?utm_medium=x&REF=y&Source=z&fbclid=1", "https://site.example/a"),
    ("https://site.example/a?b=2&&a=1&b=1#frag", "https://site.example/a?a=1&b=1&b=2"),
    ("https://site.example/a?refs=1&utm=2", "https://site.example/a?refs=1&utm=2"),
    ("  https://site.example/a/;v=1  ", "https://site.example/a;v=1"),
    ("https://site.example/a;v=1/b", "https://site.example/a;v=1/b"),
    ("https://site.example?x", "https://site.example?x"),
    ("https://site.example/#only", "https://site.example"),
    ("https://site.example/a?q=1?r=2", "https://site.example/a?q=1?r=2"),
    (None, None),
    ("", ""),
])
def test_normalize_url(column, url, canonical):
    assert column([url], urls.normalize_url) == [canonical]


def test_normalize_url_against_a_plain_formulation(column):
    def plain(url):
        parts = urlsplit(url.strip())
        kept = [p for p in parts.query.split("&") if p]
        kept = [p for p in kept if not p.split("=")[0].lower().startswith("utm_")
                and p.split("=")[0].lower() not in ("ref", "source", "fbclid")]
        query = "?" + "&".join(sorted(kept)) if kept else ""
        return f"{parts.scheme}://{parts.netloc.lower()}{parts.path.rstrip('/')}{query}"

    found = []

    @settings(max_examples=200, deadline=None, database=None)
    @given(
        st.sampled_from(["http", "https", "HTTPS"]), st.text("aB.é-", min_size=1, max_size=6),
        st.text("/aZ.%é", max_size=8), st.lists(st.text("utm_refsoc=a1Bé", max_size=8), max_size=4), st.sampled_from(["", "#x"]),
    )
    def collect(scheme, host, path, pairs, fragment):
        path = "/" + path if path else ""
        found.append(f"{scheme}://{host}{path}" + ("?" + "&".join(pairs) if pairs else "") + fragment)

    collect()
    assert column(found, urls.normalize_url) == [plain(u) for u in found]


def test_host_and_validity(column):
    assert column(["https://U@H.example:1/x", "//h/p", "no", None], urls.url_host) == ["u@h.example:1", "h", "", None]
    good = ["http://a.b", " HTTPS://a.b/c?d#e ", "https://ab"]
    bad = ["https://a", "https://.a", "https:///a", "https://a b c", "ftp://a.b", "a.b", "", None, "https://a.b/ c"]
    assert column(good + bad, urls.valid_url) == [True] * len(good) + [False] * len(bad)


@pytest.mark.parametrize("shown, expected", [
    ("2024-01-15T10:30:00Z", "2024-01-15T10:30:00Z"),
    ("2024-01-15T10:30:00+02:00", "2024-01-15T08:30:00Z"),
    ("2024-01-15T10:30:00-0330", "2024-01-15T14:00:00Z"),
    ("2024-01-15T10:30:00.987654Z", "2024-01-15T10:30:00Z"),
    ("2024-01-15 10:30", "2024-01-15T10:30:00Z"),
    ("2024-01-15", "2024-01-15T00:00:00Z"),
    ("20240115", "2024-01-15T00:00:00Z"),
    ("2024/1/5", "2024-01-05T00:00:00Z"),
    ("2024-1-5T1:2:3Z", "2024-01-05T01:02:03Z"),
    ("5 jan 2024", "2024-01-05T00:00:00Z"),
    ("05 September 2024", "2024-09-05T00:00:00Z"),
    ("Jan 5, 2024", "2024-01-05T00:00:00Z"),
    ("  december 31,  1999 ", "1999-12-31T00:00:00Z"),
    ("Sat, 06 Jan 2024 23:00:00 -0200", "2024-01-07T01:00:00Z"),
    ("Mon, 6 Jan 2024 23:00:00 GMT", "2024-01-06T23:00:00Z"),
    ("posted 3 hrs ago, edited", "2024-03-10T06:30:15Z"),
    ("2 Weeks  ago", "2024-02-25T09:30:15Z"),
    ("1 month ago", "2024-02-09T09:30:15Z"),
    ("90 secs ago", "2024-03-10T09:28:45Z"),
    ("2 years ago", None), ("31 Feb 2024", None), ("2024-02-30", None), ("2024", None), ("2024-01", None),
    ("10:30", None), ("epoch", None), ("99999999999999999999 days ago", None), ("9999999 weeks ago", None),
    ("Jan 5 2024", None), ("2024.01.05", None), ("", None), ("   ", None), (None, None), ("24:00", None),
    ("2024-01-15T25:00:00Z", None), ("Sonntag, 06 Jan 2024 23:00:00 GMT", None),
])
def test_parse_date(column, shown, expected):
    assert column([shown], lambda x: dates.parse_date(x, AS_OF)) == [expected]


def test_as_of_is_taken_as_utc(column):
    aware = datetime(2024, 3, 10, 11, 30, 15, tzinfo=timezone(timedelta(hours=2)))
    assert column(["1 hour ago"], lambda x: dates.parse_date(x, aware)) == ["2024-03-10T08:30:15Z"]


def test_freshness_at_its_edges(column):
    def at(**back):
        return (AS_OF - timedelta(**back)).isoformat() + "Z"

    shown = [at(), at(hours=24), at(hours=24, seconds=1), at(seconds=-1), "5 hours ago", "nonsense", None]
    assert column(shown, lambda x: dates.is_fresh(x, AS_OF)) == [True, True, False, False, True, False, False]


@pytest.mark.parametrize("raw, norm", [
    ("Fathom Robotics, Inc.", "fathom robotics"), ("  ACME   GmbH ", "acme"), ("Company Co Star", "star"),
    ("Élan & Söhne Ltd.", "élan söhne"), ("a.b-c corp", "abc"), ("Incline", "incline"), ("LLC", ""), ("under_score", "under_score"),
    (None, ""), ("  ", ""),
])
def test_normalize_entity_name(column, raw, norm):
    assert column([raw], names.normalize_entity_name) == [norm]


def test_sequence_ratio_is_directed_and_rounded_on_the_binary_value(spark):
    from difflib import SequenceMatcher

    pairs = [("stabilityai", "stability ai"), ("tide", "diet"), ("diet", "tide"), ("", ""), ("a", ""), ("a" * 37 + "bcd", "a" * 37 + "efg")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(names.sequence_score("a", "b").alias("s"), "a", "b").collect()
    for r in rows:
        ratio = SequenceMatcher(None, r.a, r.b).ratio()
        assert (r.s.ratio, r.s.rounded) == (ratio, round(ratio, 2))


def test_repository_links(column):
    links = ["https://github.com/o/r.git", "see HTTP://GitHub.com/o/r/tree/main", "https://github.com/o", "https://gitlab.com/o/r", None, "https://github.com/a.b/toolkit"]
    got = column(links, repos.github_owner_repo)
    assert [tuple(g) if g else None for g in got] == [("o", "r"), ("o", "r"), None, None, None, ("a.b", "toolkit")]
    assert column(links[-1:], repos.github_url_clean) == ["https://github.com/a.b/toolkit"]
    assert column(links[-1:], lambda x: repos.github_url_clean(x, compat=True)) == ["https://github.com/a.b/toolk"]


def test_code_fences_and_json(column):
    raw = ['```json\n{"a": 1}\n```', "```\n[1]```", " {} ", "```JSON {}", None, "text ```x```"]
    assert column(raw, records.strip_code_fence) == ['{"a": 1}', "[1]", "{}", "{}", "", "text ```x```"]
    shown = ['{"a": 1, "a": 2}', "[1, 2]", "{'a': 1}", '{"a": 1} tail', '{"a": NaN}', "", None, "7"]
    got = [(p.json, p.kind) for p in column(shown, records.parse_json_strict)]
    assert got == [('{"a": 2}', "dict"), ("[1, 2]", "list"), (None, None), (None, None), (None, None), (None, None), (None, None), ("7", "int")]


def test_small_columns(column):
    assert column(["Title: A", " title:B ", "Titles: C", "title:"], text.strip_title_prefix) == ["A", "B", "Titles: C", ""]
    assert column(["free", "Paid", "gratis", "", None], records.valid_pricing) == [True, True, False, False, True]
    assert column([0, 5, -1, None], records.nonneg_int, "x int") == [True, True, False, True]
    assert column(['["a", "b"]', "oops", None, "[]"], lambda x: text.join_authors(text.decode_authors(x))) == ["a, b", "", "", ""]
    prompts = column(["Be brief.", "", None], records.build_prompt)
    assert prompts[0] == "Be brief.\n" + records.JSON_INSTRUCTION and prompts[1] == prompts[2] == records.JSON_INSTRUCTION
