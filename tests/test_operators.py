"""Dedup, outcomes, joins, validation, merges, responses: against plain Python on small fixtures."""

import json
import random
from datetime import datetime
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleanwork.operators import dedup, enrich, fetch, lookup, records, resolve, responses, upsert, validate


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# -- dedup and fetch ------------------------------------------------------------------------------


@pytest.fixture
def crawled(spark):
    data = [
        (5, "https://a.b/x?utm_id=1", "five", None), (2, "https://A.b/x/", None, "timeout"), (3, "https://a.b/y", "three", None),
        (9, "https://a.b/x#z", "nine", None), (1, None, "one", None), (4, None, "four", None),
    ]
    return spark.createDataFrame(data, "seq bigint, url string, content string, error string")


def test_dedup_marks_later_arrivals(crawled):
    got = rows(dedup.dedup_urls(crawled, "mark").select("seq", "normalized_url", "content", "error"), "seq")
    assert got == [
        (1, None, "one", None), (2, "https://a.b/x", None, "timeout"), (3, "https://a.b/y", "three", None), (4, None, "four", None),
        (5, "https://a.b/x", None, "Duplicate URL"), (9, "https://a.b/x", None, "Duplicate URL"),
    ]


def test_a_failed_first_fetch_still_blocks_later_ones(crawled):
    assert [r[0] for r in rows(dedup.drop_failed(dedup.dedup_urls(crawled, "drop")).select("seq"), "seq")] == [1, 3, 4]
    with pytest.raises(ValueError):
        dedup.dedup_urls(crawled, "other")


def test_skip_seen(spark, crawled):
    seen = spark.createDataFrame([("https://a.b/x",), ("https://a.b/x",)], "normalized_url string")
    assert [r[0] for r in rows(dedup.skip_seen(crawled, seen).select("seq"), "seq")] == [1, 3, 4]


def test_fetch_outcome(spark):
    log = {
        "ok": [503, None, 200, 404], "gone": [404], "large": [429, 413], "limit": [429] * 6, "down": [500] * 5, "net": [None] * 5,
        "pending": [429, 503],
    }
    data = [(u, i, s, f"body{i}" if s == 200 else None, None if s else f"Boom: {i}", float(i)) for u, ss in log.items() for i, s in enumerate(ss)]
    attempts = spark.createDataFrame(data, "url string, attempt int, status int, content string, exception string, elapsed_seconds double")
    attempts = attempts.withColumn("headers", F.create_map(F.lit("k"), F.col("attempt").cast("string")))
    got = fetch.fetch_outcome(attempts).select("url", "status_code", "content", "error", "attempts", "retryable")
    assert rows(got, "url") == [
        ("down", 500, None, "HTTP 500 server error", 5, False),
        ("gone", 404, None, "HTTP status 404", 1, False),
        ("large", 413, None, "HTTP 413: Payload Too Large", 2, False),
        ("limit", 429, None, "HTTP 429: Too Many Requests (exceeded 4 retries)", 5, False),
        ("net", None, None, "Boom: 4", 5, False),
        ("ok", 200, "body2", None, 3, False),
        ("pending", 503, None, "HTTP 503 server error", 2, True),
    ]


# -- joins ----------------------------------------------------------------------------------------


def test_lookup_join_with_hot_missing_and_null_keys(spark):
    keys = ["hot"] * 900 + [f"k{i % 1500}" for i in range(3000)] + [None] * 200 + ["hot-unknown"] * 300
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    table = spark.createDataFrame([("hot", 1, "h")] + [(f"k{i}", i, "c") for i in range(0, 1500, 2)], "k string, v int, w string")
    assert set(lookup.hot_keys(left, "k")) == {"hot", "hot-unknown"}
    got = {r.i: (r.k, r.v, r.w) for r in lookup.lookup_join(left, table, "k").collect()}
    known = {r.k: (r.v, r.w) for r in table.collect()}
    assert got == {i: (k, *known.get(k, (None, None))) for i, k in enumerate(keys)}


def test_enrich_repo_stars(spark):
    links = [(1, "https://github.com/o/r/tree/x"), (2, "http://github.com/o/gone.git"), (3, "https://github.com/o/new"), (4, "else"), (5, ""), (6, None)]
    papers = spark.createDataFrame(links, "id int, github_url string")
    stats = spark.createDataFrame([("o", "r", 200, 12), ("o", "gone", 404, None), ("o", "r", 500, None)], "owner string, repo string, status int, stargazers_count int")
    assert rows(enrich.enrich_repo_stars(papers, stats), "id") == [
        (1, "https://github.com/o/r", 12), (2, "https://github.com/o/gone", None), (3, "https://github.com/o/new", None),
        (4, "else", None), (5, None, None), (6, None, None),
    ]


def test_canonicalize_ref(spark):
    data = spark.createDataFrame([(1, " Acme "), (2, "Other"), (3, None)], "id int, name string")
    known = spark.createDataFrame([(1, "Acme", "old"), (2, "Acme", "ACME Corp")], "id bigint, raw_name string, canonical_name string")
    assert rows(enrich.canonicalize_ref(data, known, "name"), "id") == [(1, "ACME Corp"), (2, "Other"), (3, None)]


# -- resolution -----------------------------------------------------------------------------------


def plain_resolution(raw, canonicals, aliases, threshold):
    import re

    def norm(name):
        low = re.sub(r"[^\w\s]", "", name.strip().lower())
        low = re.sub(r"\b(" + "|".join(("inc", "llc", "corp", "ltd", "co", "company", "gmbh")) + r")\b", "", low)
        return re.sub(r"\s+", " ", low).strip()

    if not raw or not raw.strip():
        return "Unknown", "unresolved", 0.0
    clean = raw.strip()
    key = norm(clean)
    if key in aliases:
        return aliases[key], "alias", 1.0
    for name in canonicals:
        if norm(name) == key:
            return name, "normalized", 1.0
    scored = [(SequenceMatcher(None, key, norm(name)).ratio(), -i, name) for i, name in enumerate(canonicals)]
    ratio, _, name = max(scored, default=(0.0, 0, None))
    if ratio > 0 and ratio >= threshold:
        return name, "fuzzy", round(ratio, 2)
    return clean, "unresolved", 0.5 if ratio > 0 else 0.0


@pytest.mark.parametrize("threshold", [0.85, 0.7, 0.5])
def test_resolution_against_brute_force(spark, threshold):
    rnd = random.Random(11)

    def word(letters, most):
        return "".join(rnd.choice(letters) for _ in range(rnd.randint(1, most))).strip() or "q"

    canonicals = [word("abcd e", 16) for _ in range(90)] + [f"Central Institute of Applied Learning Number {i} Ltd" for i in range(4)]
    canonicals += ["Twin A1", "Twin A2", "ab", "a", "Inc"] + ["é" * 30 + "x" * 20 + str(i) for i in range(3)]

    def damaged(name):
        letters = list(name)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(letters) + 1)
            if rnd.random() < 0.4 and len(letters) > 1:
                letters.pop(min(at, len(letters) - 1))
            else:
                letters.insert(at, rnd.choice("abxyé "))
        return "".join(letters)

    raws = list({damaged(rnd.choice(canonicals)) for _ in range(350)}) + ["Twin A", "nick, Inc.", "###", "LLC", " ", "", None, "zz", "ba"]
    aliases = {"nick": "Nicholas"}
    names = spark.createDataFrame([(i, r, "T", "u") for i, r in enumerate(raws)], "i int, raw_name string, entity_type string, source_url string")
    got = resolve.resolve_entities(
        names, spark.createDataFrame(list(enumerate(canonicals)), "pos int, name string"),
        spark.createDataFrame(list(aliases.items()), "norm string, canonical string"), threshold,
    )
    found = {r.i: (r.canonical_name, r.resolution_method, r.confidence) for r in got.collect()}
    assert found == {i: plain_resolution(r, canonicals, aliases, threshold) for i, r in enumerate(raws)}


def test_default_aliases(spark):
    names = spark.createDataFrame([("Open AI, Inc.", "T", None), ("Mistral", "T", None)], "raw_name string, entity_type string, source_url string")
    none = spark.createDataFrame([], "pos int, name string")
    got = resolve.resolve_entities(names, none)
    assert {(r.raw_name, r.canonical_name, r.resolution_method) for r in got.collect()} == {
        ("Open AI, Inc.", "OpenAI", "alias"), ("Mistral", "Mistral AI", "alias")
    }
    assert rows(resolve.resolution_summary(got), "resolution_method") == [("alias", 2, 1.0)]


def test_hot_grams_are_not_join_keys(spark):
    """Names that share a long boilerplate part meet only where they may match."""
    theme = "worldwide business holding "
    forms = spark.createDataFrame([(i, f"{theme}{i * 7919:08x}{i * 104729:08x}") for i in range(300)], "pos int, norm string").withColumn("name", F.col("norm"))
    pairs = resolve.fuzzy_candidates(forms.select("norm"), forms, 0.95)
    assert 300 <= pairs.count() < 300 * 30


def test_review_queue(spark):
    names = spark.createDataFrame([("northwind trading",), ("northwind tradxxxx",), ("nothing alike",)], "raw_name string")
    canon = spark.createDataFrame([(0, "Northwind Trading")], "pos int, name string")
    queue = resolve.review_queue(names, canon, spark.createDataFrame([], "norm string, canonical string"))
    assert {(r.norm, r.fuzzy_name) for r in queue.collect()} == {("northwind tradxxxx", "Northwind Trading"), ("nothing alike", None)}
    with pytest.raises(ValueError, match="2/3"):
        resolve.review_queue(names, canon, floor=0.5)


# -- validation -----------------------------------------------------------------------------------


def test_validation_lists_every_broken_rule(spark):
    kind = "recordType string, content struct<startupName:string, pricingModel:string>, source struct<name:string,url:string>"
    data = [
        ("PRODUCT", ("A", "free"), ("s", "https://s.b")), ("PRODUCT", ("", "cheap"), ("s", None)), (None, ("A", None), None), ("JOB", None, ("s", " https://s.b ")),
    ]
    checked = validate.validate_products(spark.createDataFrame(data, kind))
    assert [r.reasons for r in checked.collect()] == [
        [], ["source.url", "content.startupName", "content.pricingModel"], ["recordType", "source.url"], ["recordType", "content.startupName"],
    ]
    valid, rejected = validate.split_valid(checked)
    assert valid.count() == 1 and rejected.count() == 3 and "reasons" not in valid.columns
    assert rows(validate.validation_summary(checked), "rule") == [
        ("content.pricingModel", 1), ("content.startupName", 2), ("recordType", 2), ("source.url", 2)
    ]
    with pytest.raises(Exception, match="invalid record: source.url"):
        validate.validate_products(spark.createDataFrame(data[1:2], kind), fail_fast=True).collect()


def test_paper_rules(spark):
    kind = "recordType string, paper_url string, github_url string, github_stars int"
    data = [("RESEARCH_PAPER", "https://p.q", None, None), ("RESEARCH_PAPER", "https://p.q", "", 0), ("RESEARCH_PAPER", "p", "g", -1)]
    checked = validate.validate_papers(spark.createDataFrame(data, kind))
    assert [r.reasons for r in checked.collect()] == [[], [], ["paper_url", "github_url", "github_stars"]]


# -- merges ---------------------------------------------------------------------------------------


def test_paper_merge_against_one_by_one(spark):
    rnd = random.Random(3)
    keys = [f"https://p/{i}" for i in range(12)]

    def record(i):
        pick = rnd.choice
        return (pick(keys + keys[:1] * 12), pick([None, "", f"t{i}"]), pick([None, [], [f"a{i}"]]), pick([None, "", f"g{i}"]), pick([None, 0, i]), pick([None, f"d{i}"]))

    stored = {k: [k, "old", ["x"], None, 3, "d"] for k in keys[:4]}
    expected = {k: list(v) for k, v in stored.items()}
    batch = [record(i) for i in range(120)]
    for key, title, authors, link, stars, day in batch:
        if key not in expected:
            expected[key] = [key, title, authors or [], link, stars, day]
            continue
        row = expected[key]
        row[1:4] = [title or row[1], authors or row[2], link or row[3]]
        row[4] = row[4] if stars is None else stars
        row[5] = day or row[5]
    ddl = "paper_url string, title string, authors array<string>, github_url string, github_stars int, published_date string"
    snapshot = spark.createDataFrame([(i, *v) for i, v in enumerate(stored.values())], f"id bigint, {ddl}")
    delta = spark.createDataFrame([(i, *r) for i, r in enumerate(batch)], f"seq bigint, {ddl}")
    shuffled = delta.withColumn("authors", F.coalesce("authors", F.array().cast("array<string>"))).orderBy(F.rand(1))
    merged = upsert.upsert_papers(snapshot, shuffled)
    got = {r.paper_url: [r.paper_url, r.title, r.authors, r.github_url, r.github_stars, r.published_date] for r in merged.collect()}
    assert got == expected
    firsts = {k: min(i for i, r in enumerate(batch) if r[0] == k) for k in expected if k not in stored}
    assert {r.paper_url: r.seq for r in merged.where("id IS NULL").collect()} == firsts


def test_job_and_news_merges_touch_title_and_freshness_only(spark):
    ddl = "source_url string, company_name string, title string, published_date string, is_fresh boolean"
    snapshot = spark.createDataFrame([(1, "u", "C", "old", "d", False)], f"id bigint, {ddl}")
    delta = spark.createDataFrame(
        [(1, "u", "D", "", "e", True), (2, "u", "D", None, "e", None), (3, "n", None, None, None, None), (4, "n", "X", "later", "e", None)], f"seq bigint, {ddl}"
    )
    got = {r.source_url: tuple(r) for r in upsert.upsert_jobs(snapshot, delta).select(snapshot.columns).collect()}
    assert got == {"u": (1, "u", "C", "", "d", True), "n": (None, "n", "Unknown", "later", None, False)}
    news = upsert.upsert_news(snapshot.drop("company_name"), delta.drop("company_name").where("seq = 3"))
    assert news.where("source_url = 'n'").first().title == "Untitled"


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_ids_are_dense_in_arrival_order(spark, ranges):
    seqs = [10**9] + list(range(0, 1000)) + [7 * 10**12 + i for i in range(500)] + [-5]
    numbered = upsert.assign_ids(spark.createDataFrame([(s,) for s in seqs], "seq bigint").repartition(8), 100, ranges=ranges)
    assert [(r.id, r.seq) for r in numbered.orderBy("seq").collect()] == [(101 + i, s) for i, s in enumerate(sorted(seqs))]
    assert upsert.assign_ids(spark.createDataFrame([], "seq bigint"), 0).count() == 0


def test_union_and_flatten(spark):
    startup = spark.createDataFrame([(None, None, ("N", None), ("s", "u"))], "schemaVersion string, recordType string, content struct<entityName:string,data:struct<employeeCount:int>>, source struct<name:string,url:string>")
    flat = records.flatten_startup(startup).first()
    assert (flat.schema_version, flat.record_type, flat.entity_name, flat.employee_count, flat.source_url) == ("1.0", "STARTUP", "N", None, "u")
    stamped = records.stamp_collected_at(startup, datetime(2024, 1, 1)).first()
    assert stamped.collected_at == datetime(2024, 1, 1)
    assert set(records.union_records(startup, startup.select("recordType")).columns) == set(startup.columns)


# -- responses ------------------------------------------------------------------------------------


def test_merge_extractions(spark):
    data = [
        ("a", "p1", 0, False, '{"x": 1}', None), ("a", "p2", 1, True, "nope", None), ("a", "p3", 2, True, '```json\n{"x": 3}\n```', None),
        ("b", "p1", 0, True, None, "quota"), ("b", "p2", 1, True, "{} tail", None), ("c", "p1", 0, False, "{}", None),
        ("d", "p2", 1, True, "{}", None), ("d", "p1", 0, True, "[1]", None),
    ]
    table = spark.createDataFrame(data, "request_id string, provider string, priority int, available boolean, raw_output string, error string")
    got = {r.request_id: (r.json, r.provider, r.error) for r in responses.merge_extractions(table).collect()}
    assert got["a"] == ('{"x": 3}', "p3", None) and got["d"] == ("[1]", "p1", None)
    head = "LLM Extraction failed across all providers: "
    assert got["c"] == (None, None, head + "No LLM providers available or configured.")
    assert got["b"][2] == head + (
        "LLM provider 'p1' failed: quota; LLM provider 'p2' failed: Failed to parse JSON response from p2: Extra data: line 1 column 4 (char 3)"
    )
    objects = {r.request_id: r.provider for r in responses.merge_extractions(table, require_object=True).collect()}
    assert objects["d"] == "p2"
    assert {r.request_id for r in responses.collect_errors(table).collect()} == {"b", "c"}


def test_extract_with_asks_in_order(spark):
    def first(prompt, system):
        if "1" in prompt:
            raise ValueError("busy")
        return "```\n" + json.dumps({"by": "first", "system": system}) + "\n```"

    def second(prompt, system):
        return "not json" if "11" in prompt else '{"by": "second"}'

    asked = spark.createDataFrame([(i, f"q{i}", "s" if i == 0 else None) for i in (0, 1, 11)], "request_id int, prompt string, system_prompt string")
    got = {r.request_id: (r.json, r.provider, r.error) for r in responses.extract_with(asked, [("one", first), ("two", second)]).collect()}
    assert got["0"] == ('{"by": "first", "system": "s"}', "one", None)
    assert got["1"] == ('{"by": "second"}', "two", None)
    assert got["11"][2].endswith("LLM provider 'one' failed: busy; LLM provider 'two' failed: Failed to parse JSON response from two: Expecting value: line 1 column 1 (char 0)")


def test_late_answers_and_blank_names_count(spark):
    from gleanwork.operators.enrich import canonicalize_ref
    from gleanwork.operators.fetch import fetch_outcome

    ddl = "url string, attempt int, status int, content string, headers string, exception string, elapsed_seconds double"
    log = [("u", i, 503, None, None, None, 0.1) for i in range(5)] + [("u", 5, 200, "page", None, None, 0.1)]
    row = fetch_outcome(spark.createDataFrame(log, ddl)).first()
    assert (row.status_code, row.content, row.attempts, row.error, row.retryable) == (200, "page", 6, None, False)
    mappings = spark.createDataFrame([(" ", "Unknown"), (" Acme ", "Acme Inc")], "raw_name string, canonical_name string")
    names = spark.createDataFrame([("  ",), ("Acme",), (None,)], "name string")
    assert [r.name for r in canonicalize_ref(names, mappings, "name").collect() if r.name].count("Unknown") == 1
    assert "Acme Inc" in [r.name for r in canonicalize_ref(names, mappings, "name").collect()]


def test_params_of_an_earlier_segment_are_path(column):
    from gleanwork.functions.urls import normalize_url

    assert column(["https://a.b/p;x/?ref=1", "https://a.b/p/;x", "https://a.b/q;y"], normalize_url) == [
        "https://a.b/p;x", "https://a.b/p;x", "https://a.b/q;y"]
