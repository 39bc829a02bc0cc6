"""The registered queries: every operator over whole tables.

The tables hold no social or job markup, so those chains read HTML assembled from columns; the
checks then compute the answer from the columns directly.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.functions import dates, names, records as record_columns, repos, text, urls
from gleanwork.functions.sql import register_sql
from gleanwork.operators import (
    chunk, dedup, enrich, extract, fetch, html, records, resolve, responses, upsert, validate,
)
from gleanwork.plans import jobs
from gleanwork.session import ensure_settings, scratch_dir, staged
from gleanwork.sources.export import LAYOUTS, export_layout, write_csv
from gleanwork.sources import inputs
from gleanwork.sources.inputs import spread
from gleanwork.sources.store import TableStore
from gleanwork.streaming import streams
from gleanwork import schemas

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
BATCH_TS = datetime(2024, 2, 1)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(ensure_settings(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Only these columns of a table, spread over the cores, for stages that parse."""
    return spread(table(spark, sf_dir, name).select(*columns))


def text_of(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def every(key: str, n: int, *options: Column | str) -> Column:
    """The option numbered key % n; the last one for all numbers beyond."""
    number = F.col(key) % n
    chosen = None
    for i, option in enumerate(options[:-1]):
        value = F.lit(option) if isinstance(option, str) else option
        chosen = F.when(number == i, value) if chosen is None else chosen.when(number == i, value)
    last = options[-1]
    return chosen.otherwise(F.lit(last) if isinstance(last, str) else last)


def nothing() -> Column:
    return F.lit(None).cast("string")


# -- URLs -----------------------------------------------------------------------------------------


@query
def normalize_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normalized_url"))


@query
def normalize_url_built(spark, sf_dir):
    """Upper-case hosts with ports, repeated slashes, `;params`, mixed tracking and empty pairs."""
    key = F.col("c_custkey")
    built = text_of(
        "  HTTPS://Shop", key % 50, ".Example.COM:8443/", F.col("c_mktsegment"), "/", key % 9, "//",
        "?b=", key % 4, "&&a=", key % 3, "&UTM_Source=x&ref=", key, "&fbclid=1&source=q", "#part", " ",
    )
    return table(spark, sf_dir, "customer").select("c_custkey", urls.normalize_url(built).alias("normalized_url"))


@query
def sql_functions(spark, sf_dir):
    """The functions offered to `spark.sql`, over all pages and their titles as names."""
    register_sql(spark)
    table(spark, sf_dir, "pages").select("page_id", "url").createOrReplaceTempView("sql_pages")
    return spark.sql("SELECT page_id, normalize_url(url) AS normalized_url, valid_url(url) AS is_valid FROM sql_pages")


@query
def read_pages(spark, sf_dir):
    """Fetched pages stored under the declared schema and read back, with what a failed fetch leaves out."""
    path, failed = scratch_dir(spark, "pages"), F.col("page_id") % 10 == 0
    columns = {"seq": F.col("page_id"), "url": F.col("url"), "status_code": F.when(failed, 503).otherwise(200),
               "content": F.when(~failed, F.col("html")), "error": F.when(failed, "HTTP 503 server error")}
    stored = table(spark, sf_dir, "pages").select(*[c.alias(n) for n, c in columns.items()])
    stored.write.parquet(path)
    return inputs.read_pages(spark, path).select("seq", "url", "status_code", F.length("content").alias("n_chars"), "error", "source_name")


@query
def read_lookups(spark, sf_dir):
    """Aliases and canonical names stored as lookup tables, read back and used: every customer's market by its nickname."""
    path = scratch_dir(spark, "lookups")
    markets = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.min("c_custkey").cast("int").alias("pos"))
    markets.select("pos", "name").write.parquet(f"{path}/canonicals")
    markets.select(F.concat(F.lit("the "), F.lower("name")).alias("norm"), F.col("name").alias("canonical")).write.parquet(f"{path}/aliases")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", text_of("The ", F.col("c_mktsegment"), every("c_custkey", 2, " Inc.", "")).alias("raw_name"),
        F.lit("MARKET").alias("entity_type"), nothing().alias("source_url"))
    found = resolve.resolve_entities(rows, inputs.read_canonicals(spark, f"{path}/canonicals"), inputs.read_aliases(spark, f"{path}/aliases"))
    return found.select("c_custkey", "canonical_name", "resolution_method")


@query
def host_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(urls.url_host(F.col("url")).alias("host"))
    return pages.groupBy("host").agg(F.count("*").alias("n_pages"))


@query
def valid_url(spark, sf_dir):
    """Every way a URL can be broken, by customer key."""
    key = F.col("c_custkey")
    url = every(
        "c_custkey", 8, text_of("https://ok.example/", key), text_of(" HTTP://ok.example?q=", key), text_of("ftp://no/", key),
        text_of("https://", key, " .example"), text_of("https:///", key), "", nothing(), text_of("x https://", key),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", urls.valid_url(url).alias("is_valid"))


def _twin_pages(spark, sf_dir, *extra):
    """Every page twice: under its own URL, and under the same with a tracking parameter."""
    mark = F.when(F.contains("url", F.lit("?")), "&").otherwise("?")
    forms = F.array(F.col("url"), text_of(F.col("url"), mark, "utm_campaign=", F.col("page_id")))
    pages = table(spark, sf_dir, "pages").select("page_id", *extra, F.posexplode(forms).alias("form", "url"))
    return pages.withColumn("seq", F.col("page_id") * 2 + F.col("form")).drop("page_id", "form")


@query
def dedup_urls(spark, sf_dir):
    pages = _twin_pages(spark, sf_dir, F.col("html").alias("content"))
    marked = dedup.dedup_urls(pages, "mark")
    return marked.select("seq", "normalized_url", F.length("content").alias("n_chars"), "error")


@query
def dedup_urls_drop(spark, sf_dir):
    return dedup.dedup_urls(_twin_pages(spark, sf_dir), "drop").select("seq", "normalized_url")


@query
def skip_seen(spark, sf_dir):
    pages = _twin_pages(spark, sf_dir)
    seen = dedup.with_normalized_url(pages.where("seq % 10 = 0"))
    return dedup.skip_seen(pages, seen).select("seq", "normalized_url")


@query
def skip_seen_history(spark, sf_dir):
    """Line items as pages, a third of them one URL, against a history in four parts, each with a stored filter."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    hot = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_partkey"))
    pages = items.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), text_of("https://S.example/", hot, "/?utm_id=", F.col("l_orderkey")).alias("url"))
    parts = table(spark, sf_dir, "part").where("p_partkey % 5 < 2")
    seen = parts.select(F.col("p_partkey") % 4, text_of("https://s.example/", F.col("p_partkey"))).toDF("part", "normalized_url")
    seen = staged(seen.unionAll(spark.range(1).select(F.lit(0).cast("bigint"), F.lit("https://s.example/0"))), "history")
    filters = staged(dedup.url_filter(seen, "part"), "history-filters")
    return dedup.skip_seen(pages, seen, dedup.merged_filter(filters)).select("seq", "normalized_url")


@query
def drop_failed(spark, sf_dir):
    return dedup.drop_failed(dedup.dedup_urls(_twin_pages(spark, sf_dir), "mark")).select("seq", "url")


@query
def fetch_outcome(spark, sf_dir):
    """Attempt log from all events: one URL for each group of users, its events are the attempts."""
    events = table(spark, sf_dir, "events")
    status = every(
        "event_id", 7, F.lit(429), F.lit(503), F.lit(None).cast("int"), F.lit(500), F.lit(413), F.lit(404), F.lit(200)
    )
    log = events.select(
        text_of("https://e.example/", F.col("user_id") % 400).alias("url"),
        "event_id",
        status.alias("status"),
        F.when(status == 200, text_of("body ", F.col("event_id"))).alias("content"),
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.when(status.isNull(), text_of("TimeoutError: ", F.col("event_id"))).alias("exception"),
        F.col("value").alias("elapsed_seconds"),
    )
    place = F.row_number().over(Window.partitionBy("url").orderBy("event_id")) - 1
    return fetch.fetch_outcome(log.withColumn("attempt", place).drop("event_id")).drop("headers")


# -- dates ----------------------------------------------------------------------------------------


@query
def parse_date_formats(spark, sf_dir):
    """Order dates printed in each accepted notation, at an hour derived from the key."""
    day = F.col("o_orderdate")
    at = F.timestamp_seconds(F.unix_timestamp(day) + (F.col("o_orderkey") % 86400))
    shown = every(
        "o_orderkey", 14,
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        text_of(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), "+05:30"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy/M/d"),
        F.date_format(day, "d MMM yyyy"),
        F.lower(F.date_format(day, "dd MMMM yyyy")),
        F.date_format(day, "MMM d, yyyy"),
        F.date_format(day, " MMMM dd, yyyy "),
        text_of("Mon, ", F.date_format(at, "d MMM yyyy HH:mm:ss"), " -0800"),
        text_of("Tue, ", F.date_format(at, "dd MMM yyyy HH:mm:ss"), " GMT"),
        F.date_format(day, "yyyyMMdd"),
        text_of("on ", F.date_format(day, "yyyy.MM.dd")),
    )
    return wide(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", dates.parse_date(shown, AS_OF).alias("published_date"))


@query
def relative_date(spark, sf_dir):
    units = ("second", "secs", "minutes", "MIN", "hours", "hrs", "day", "weeks", "Months", "years")
    unit = every("event_id", len(units), *units)
    phrase = text_of("seen ", F.floor("value").cast("int"), "  ", unit, " ago by ", F.col("user_id"))
    return wide(spark, sf_dir, "events", "event_id", "value", "user_id", "ts").select("event_id", dates.parse_date(phrase, F.col("ts")).alias("published_date"))


@query
def fresh_events(spark, sf_dir):
    """Freshness against one as-of, with rows moved onto both ends of the window."""
    edge = every(
        "event_id", 50,
        F.lit(AS_OF.isoformat() + "Z"), F.lit((AS_OF - timedelta(hours=24)).isoformat() + "Z"),
        F.lit((AS_OF - timedelta(hours=24, seconds=1)).isoformat() + "Z"), F.lit("no date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    return wide(spark, sf_dir, "events", "event_id", "ts").select("event_id", dates.is_fresh(edge, AS_OF).alias("is_fresh"))


@query
def freshness_summary(spark, sf_dir):
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, sf_dir, "events").select("event_type", dates.is_fresh(shown, AS_OF).alias("is_fresh"))
    return rows.groupBy("event_type", "is_fresh").agg(F.count("*").alias("n_rows"))


# -- HTML -----------------------------------------------------------------------------------------


@query
def html_title(spark, sf_dir):
    pages = wide(spark, sf_dir, "pages", "page_id", "html")
    return html.html_facts(pages, ["title"], "html").select("page_id", text.py_strip(F.col("title")).alias("title"))


@query
def html_h1(spark, sf_dir):
    return html.html_facts(wide(spark, sf_dir, "pages", "page_id", "html"), ["h1"], "html")


@query
def html_links(spark, sf_dir):
    """Links per page, in document order."""
    facts = html.html_facts(wide(spark, sf_dir, "pages", "page_id", "html"), ["hrefs"], "html")
    return facts.select("page_id", F.size("hrefs").cast("bigint").alias("n_links"), F.array_join("hrefs", " ").alias("links"))


@query
def clean_text(spark, sf_dir):
    return html.clean_text(wide(spark, sf_dir, "pages", "page_id", "html"), "html")


def _news_pages(spark, sf_dir):
    """News pages from orders: every source of every field takes its turn by key."""
    key = F.col("o_orderkey")
    at = F.timestamp_seconds(F.lit(int((AS_OF - datetime(1970, 1, 1)).total_seconds())) - (key % 60) * 3600 + 1800)
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    title, summary = text_of("Order ", key, " &amp; more"), text_of("About ", F.col("o_orderpriority"))
    head = every(
        "o_orderkey", 5,
        text_of('<meta property="og:title" content=" ', title, ' "><meta property="og:description" content="', summary,
                '"><meta property="article:published_time" content="', iso, '">'),
        text_of('<meta name="description" content="', summary, '"><meta name="pubdate" content="', iso,
                '"><script type="application/ld+json">{broken</script><script type="application/ld+json">[1,{"x":0},'
                '{"headline":"Order ', key, ' & more"}]</script>'),
        text_of('<meta property="og:title" content=""><script type="application/ld+json">{"name":" Order ', key,
                ' & more ","description":"', summary, '","datePublished":"n/a","dateCreated":"', iso, '"}</script>'),
        text_of('<meta property="article:published_time" content="some day"><title>other</title>'),
        text_of("<title> ", title, " </title>"),
    )
    body = every(
        "o_orderkey", 5, "<h1>no</h1>", "<h1>no</h1>", '<h1>no</h1><time datetime="2001-01-01">x</time>',
        text_of("<h1>", F.lit("<b>Order "), key, "</b> <i>&amp; more</i></h1><time>x</time><time datetime='", iso, "'>y</time>"),
        "<p>plain",
    )
    content = text_of("<!DOCTYPE html><html><head>", head, "</head><body>", body, "</body></html>")
    return spread(table(spark, sf_dir, "orders")).select(
        key.alias("seq"), text_of("https://news.example/", key).alias("url"), content.alias("content"),
        F.when(key % 2 == 0, "Daily").alias("source_name"),
    )


@query
def extract_news(spark, sf_dir):
    news = extract.extract_news(_news_pages(spark, sf_dir), AS_OF, keep=("seq",))
    return news.select("seq", "recordType", "title", "content_summary", F.col("source.name").alias("source_name"),
                       F.col("source.url").alias("source_url"), "published_date", "is_fresh")


def _job_pages(spark, sf_dir):
    """Job pages from parts: postings as object, list and overriding scripts, then plain fallbacks."""
    key, name = F.col("p_partkey"), F.col("p_name")
    at = F.timestamp_seconds(F.lit(int((AS_OF - datetime(1970, 1, 1)).total_seconds())) - (key % 40) * 3600)
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")
    script = '<script type="application/ld+json">'
    content = every(
        "p_partkey", 6,
        text_of(script, '{"@type":"JobPosting","title":"', name, '","hiringOrganization":{"@type":"Organization","name":"',
                F.col("p_brand"), '"},"datePosted":"', iso, '"}</script>'),
        text_of(script, '[{"@type":"Place"},{"@type":"JobPosting","title":"', name, '","hiringOrganization":"', F.col("p_brand"),
                '"},{"@type":"JobPosting","title":"second"}]</script><time datetime="', iso, '">x</time>'),
        text_of(script, '{"@type":"JobPosting","title":"first","hiringOrganization":"', F.col("p_brand"), '","datePosted":"', iso,
                '"}</script>', script, '{"@type":"JobPosting","title":"', name, '"}</script>'),
        text_of('<meta property="og:title" content="', name, '"><meta property="og:site_name" content=" ', F.col("p_brand"),
                ' "><time datetime="soon">x</time><meta name="datePosted" content="', iso, '">'),
        text_of("<h1>", name, '</h1><meta name="author" content="', F.col("p_brand"), '"><meta property="article:published_time" content="',
                iso, '">'),
        text_of("<p>", name),
    )
    return spread(table(spark, sf_dir, "part")).select(
        key.alias("seq"), text_of("https://jobs.example/", key).alias("url"), content.alias("content")
    )


@query
def extract_jobs(spark, sf_dir):
    found = extract.extract_jobs(_job_pages(spark, sf_dir), AS_OF, keep=("seq",))
    return found.select("seq", "recordType", "company_name", "title", F.col("source.name").alias("source_name"),
                        F.col("source.url").alias("source_url"), "published_date", "is_fresh")


def _paper_pages(spark, sf_dir):
    """Paper pages from parts: citation metas, then page elements, then next to nothing."""
    key, name = F.col("p_partkey"), F.col("p_name")
    repo = text_of("https://github.com/org", key % 40, "/", F.regexp_replace(name, " ", "-"))
    content = every(
        "p_partkey", 4,
        text_of('<meta name="citation_title" content=" ', name, ' "><meta name="citation_author" content="', F.col("p_brand"),
                '"><meta name="citation_author" content=""><meta name="citation_author" content="', F.col("p_type"),
                '"><meta name="citation_date" content="soon"><meta name="citation_online_date" content="2023/', key % 12 + 1, '/',
                key % 28 + 1, '"><a href="/x">x</a><a href="', repo, '.git">code</a>'),
        text_of('<h1 class="mathjax Title"><span>Title:</span> ', name, '</h1><div class="authors">By <a>', F.col("p_brand"),
                "</a>, <a> ", F.col("p_type"), '</a> <a> </a></div><div class="dateline">[Submitted on ', key % 28 + 1,
                " Feb 2023 (v1)]</div><p>See ", repo, "/tree/main ."),
        text_of("<title>TITLE: ", name, "</title><a href='https://example.org'>x</a>"),
        "",
    )
    return spread(table(spark, sf_dir, "part")).select(
        key.alias("seq"), text_of("https://papers.example/", key).alias("url"), content.alias("content")
    )


@query
def extract_papers(spark, sf_dir):
    papers = extract.extract_papers(_paper_pages(spark, sf_dir), AS_OF, keep=("seq",))
    return papers.withColumn("authors", text.join_authors(F.col("authors"))).drop("schemaVersion")


@query
def json_ld_items(spark, sf_dir):
    """JSON-LD objects per news page."""
    facts = html.html_facts(_news_pages(spark, sf_dir).select("seq", "content"), ["ld_json"])
    items = html.json_ld_items(facts)
    return items.groupBy("seq").agg(F.count("*").alias("n_items"), F.max("script_no").alias("last_script"))


# -- text and chunks ------------------------------------------------------------------------------


@query
def chunk_documents(spark, sf_dir):
    return chunk.chunk_documents(wide(spark, sf_dir, "documents", "doc_id", "text"))


@query
def chunk_documents_small(spark, sf_dir):
    chunks = chunk.chunk_documents(wide(spark, sf_dir, "documents", "doc_id", "text"), 500, 60)
    return chunks.groupBy("doc_id").agg(
        F.count("*").alias("n_chunks"), F.sum(F.length("chunk")).alias("n_chars"), F.max(F.length("chunk")).alias("longest")
    )


@query
def chunk_documents_sql(spark, sf_dir):
    """The chunks of all documents by the table function, in SQL."""
    chunk.register_chunk_table(spark)
    wide(spark, sf_dir, "documents", "doc_id", "text").createOrReplaceTempView("chunk_source")
    return spark.sql("SELECT id AS doc_id, chunk_no, chunk FROM chunk_table(TABLE(chunk_source), 4000, 200)")


@query
def extraction_requests(spark, sf_dir):
    asked = chunk.extraction_requests(wide(spark, sf_dir, "documents", "doc_id", "text"), "Extract the names.", 2000, 100)
    return asked.groupBy("system_prompt").agg(
        F.count("*").alias("n_requests"), F.countDistinct("doc_id").alias("n_docs"), F.max(F.length("chunk")).alias("longest")
    )


@query
def strip_title_prefix(spark, sf_dir):
    shown = text_of("  TiTle:  ", F.col("p_name"), every("p_partkey", 2, " title: x ", ""))
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_title_prefix(shown).alias("title"))


@query
def authors_codec(spark, sf_dir):
    """Authors encoded to JSON, some of it damaged, decoded and joined again."""
    listed = every("p_partkey", 3, F.array("p_brand", "p_type"), F.array("p_name"), F.array().cast("array<string>"))
    stored = every("p_partkey", 5, "{oops", text.encode_authors(listed))
    return table(spark, sf_dir, "part").select("p_partkey", text.join_authors(text.decode_authors(stored)).alias("authors"))


# -- names ----------------------------------------------------------------------------------------

_LEGAL = (", Inc.", " LLC", " Corp.", " Co", " GmbH", " PLC", " Pvt Ltd", "")


@query
def normalize_entity_name(spark, sf_dir):
    raw = text_of("  ", F.initcap("p_name"), every("p_partkey", len(_LEGAL), *_LEGAL), " ")
    return table(spark, sf_dir, "part").select("p_partkey", names.normalize_entity_name(raw).alias("norm"))


def _part_names(spark, sf_dir):
    """Distinct part names as canonical list, in the order of their first part."""
    return table(spark, sf_dir, "part").groupBy(F.initcap("p_name").alias("name")).agg(F.min("p_partkey").cast("bigint").alias("pos"))


def _aliases(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    return nations.select(
        text_of("nick ", F.col("n_nationkey")).alias("norm"), F.col("n_name").alias("canonical")
    )


def _raw_names(spark, sf_dir):
    """Names to resolve, by part key: alias, equal form, one letter lost, no match, blank."""
    half = F.floor(F.length("p_name") / 2).cast("int")
    lost = F.concat(F.substr("p_name", F.lit(1), half), F.substr("p_name", half + 2))
    raw = every(
        "p_partkey", 6,
        text_of("Nick ", F.col("p_partkey") % 25, ", Inc."), text_of(F.upper("p_name"), " Ltd."), lost,
        text_of("zzqx", F.col("p_partkey") % 7), "###", " ",
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", raw.alias("raw_name"), F.lit("STARTUP").alias("entity_type"),
        text_of("https://x.example/", F.col("p_partkey")).alias("source_url"),
    )


@query
def resolve_entities(spark, sf_dir):
    return resolve.resolve_entities(_raw_names(spark, sf_dir), _part_names(spark, sf_dir), _aliases(spark, sf_dir))


@query
def resolve_fuzzy(spark, sf_dir):
    lost = _raw_names(spark, sf_dir).select(
        "p_partkey", names.normalize_entity_name(F.col("raw_name")).alias("norm")
    )
    forms = resolve.canonical_forms(_part_names(spark, sf_dir))
    best = resolve.fuzzy_join(lost.select("norm").distinct(), forms)
    return lost.join(best, "norm").select("p_partkey", "fuzzy_name", F.col("score_2").alias("confidence"))


@query
def resolve_alias(spark, sf_dir):
    norms = _raw_names(spark, sf_dir).select(names.normalize_entity_name(F.col("raw_name")).alias("norm")).distinct()
    return resolve.alias_join(norms, _aliases(spark, sf_dir)).where("alias_name IS NOT NULL")


@query
def resolve_normalized(spark, sf_dir):
    norms = _raw_names(spark, sf_dir).select(names.normalize_entity_name(F.col("raw_name")).alias("norm")).distinct()
    forms = resolve.canonical_forms(_part_names(spark, sf_dir))
    return resolve.normalized_join(norms, forms).where("equal_name IS NOT NULL")


@query
def resolution_summary(spark, sf_dir):
    resolved = resolve.resolve_entities(_raw_names(spark, sf_dir), _part_names(spark, sf_dir), _aliases(spark, sf_dir))
    return resolve.resolution_summary(resolved)


@query
def review_queue(spark, sf_dir):
    """Names with five letters appended score between the floor and the threshold, others have no candidate."""
    raw = text_of(F.col("p_name"), "xqzvj")
    raw = every("p_partkey", 3, raw, text_of("zzqx", F.col("p_partkey") % 7), raw)
    rows = table(spark, sf_dir, "part").select(raw.alias("raw_name"))
    queue = resolve.review_queue(rows, _part_names(spark, sf_dir), _aliases(spark, sf_dir), floor=0.7)
    return queue.select("norm", "fuzzy_name", F.col("score_2").alias("score"))


# -- repositories ---------------------------------------------------------------------------------


def _repo_text(key: str) -> Column:
    k = F.col(key)
    return every(
        key, 6,
        text_of("https://github.com/org", k % 50, "/tool", k % 20, ".git"),
        text_of("see HTTP://GitHub.com/org", k % 50, "/tool", k % 20, "/tree/main for more"),
        text_of("https://github.com/org", k % 50, "/tool", k % 20, "?tab=readme"),
        text_of("https://gitlab.com/org", k % 50, "/tool"), "", nothing(),
    )


@query
def github_owner_repo(spark, sf_dir):
    link = repos.github_owner_repo(_repo_text("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", link["owner"].alias("owner"), link["repo"].alias("repo"))


@query
def github_url_clean(spark, sf_dir):
    """Both forms on names that end in the trimmed letters."""
    link = text_of("https://github.com/a/", F.regexp_replace("p_name", " ", "-"), every("p_partkey", 3, "", ".git", "git"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", repos.github_url_clean(link).alias("url"), repos.github_url_clean(link, compat=True).alias("url_compat")
    )


def _repo_stats(spark, sf_dir):
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        text_of(F.when(key % 3 == 2, "gone").otherwise("org"), key % 50).alias("owner"), text_of("tool", key % 20).alias("repo"),
        F.when(key % 4 == 3, 404).otherwise(200).alias("status"),
        F.when(key % 4 != 3, F.floor("s_acctbal").cast("int")).alias("stargazers_count"),
    )


@query
def enrich_repo_stars(spark, sf_dir):
    papers = table(spark, sf_dir, "customer").select("c_custkey", _repo_text("c_custkey").alias("github_url"))
    return enrich.enrich_repo_stars(papers, _repo_stats(spark, sf_dir))


@query
def canonicalize_ref(spark, sf_dir):
    """Orders named after their customer; a third of the customers have a mapping, one is very hot."""
    customer = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text_of(" Customer ", customer).alias("entity_name"))
    mapped = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        text_of(F.when(F.col("c_custkey") % 3 == 1, "Customer ").otherwise("Former customer "), F.col("c_custkey")).alias("raw_name"),
        F.col("c_name").alias("canonical_name"),
    )
    return enrich.canonicalize_ref(rows, mapped, "entity_name")


# -- validation -----------------------------------------------------------------------------------


def _source(key: str, n: int) -> Column:
    url = every(key, n, nothing(), "not a url", text_of("https://s.example/", F.col(key)))
    return F.struct(F.lit("feed").alias("name"), url.alias("url"))


def _startups(spark, sf_dir):
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("seq"), F.lit("1.0").alias("schemaVersion"),
        every("s_suppkey", 11, "NEWS", "STARTUP").alias("recordType"),
        F.struct(
            every("s_suppkey", 7, "", nothing(), F.col("s_name")).alias("entityName"),
            F.struct((key % 5 - 1).cast("int").alias("employeeCount")).alias("data"),
        ).alias("content"),
        _source("s_suppkey", 9).alias("source"),
    )


def _products(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"), F.lit("1.0").alias("schemaVersion"),
        every("p_partkey", 11, nothing(), "PRODUCT").alias("recordType"),
        F.struct(
            every("p_partkey", 7, "", F.initcap("p_name")).alias("startupName"),
            every("p_partkey", 6, "free", "Freemium", "PAID", "enterprise", nothing(), "gratis").alias("pricingModel"),
        ).alias("content"),
        _source("p_partkey", 13).alias("source"),
    )


def _papers(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("seq"), F.lit("1.0").alias("schemaVersion"),
        every("c_custkey", 17, "JOB", "RESEARCH_PAPER").alias("recordType"),
        F.col("c_name").alias("title"), F.array("c_mktsegment").alias("authors"),
        every("c_custkey", 5, "htp://x", text_of("https://p.example/", key)).alias("paper_url"),
        every("c_custkey", 4, "", "github", nothing(), text_of("https://github.com/a/", key)).alias("github_url"),
        (key % 3 - 1).cast("int").alias("github_stars"),
        F.lit("2024-01-01T00:00:00Z").alias("published_date"),
    )


def _postings(spark, sf_dir, kind):
    extra = F.col("o_orderpriority").alias("company_name" if kind == "JOB" else "content_summary")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.lit("1.0").alias("schemaVersion"),
        every("o_orderkey", 10, "OTHER", kind).alias("recordType"),
        text_of("Title ", F.col("o_custkey")).alias("title"), extra,
        _source("o_orderkey", 6).alias("source"),
        F.date_format("o_orderdate", dates.ISO_OUTPUT).alias("published_date"), (F.col("o_orderkey") % 2 == 0).alias("is_fresh"),
    )


def _reasons(checked: DataFrame) -> DataFrame:
    return checked.select("seq", F.array_join("reasons", ",").alias("reasons"))


@query
def validate_startups(spark, sf_dir):
    return _reasons(validate.validate_startups(_startups(spark, sf_dir)))


@query
def validate_products(spark, sf_dir):
    return _reasons(validate.validate_products(_products(spark, sf_dir)))


@query
def validate_papers(spark, sf_dir):
    return _reasons(validate.validate_papers(_papers(spark, sf_dir)))


@query
def validate_jobs(spark, sf_dir):
    return _reasons(validate.validate_jobs(_postings(spark, sf_dir, "JOB")))


@query
def validate_news(spark, sf_dir):
    return _reasons(validate.validate_news(_postings(spark, sf_dir, "NEWS")))


@query
def flatten_postings(spark, sf_dir):
    """Jobs and news as table rows, in one frame."""
    jobs_, news = _postings(spark, sf_dir, "JOB"), _postings(spark, sf_dir, "NEWS")
    rows = records.union_records(records.flatten_job(jobs_, "seq"), records.flatten_news(news, "seq"))
    return rows.select("seq", "record_type", "company_name", "title", "content_summary", "source_name", "source_url", "published_date", "is_fresh")


@query
def split_valid(spark, sf_dir):
    """Valid and rejected rows, counted by kind."""
    valid, rejected = validate.split_valid(validate.validate_products(_products(spark, sf_dir)))
    parts = [part.select("seq", F.lit(kind).alias("kind")) for part, kind in ((valid, "valid"), (rejected, "rejected"))]
    return records.union_records(*parts).groupBy("kind").agg(F.count("*").alias("n_rows"), F.sum("seq").alias("sum_seq"))


@query
def validation_summary(spark, sf_dir):
    return validate.validation_summary(validate.validate_papers(_papers(spark, sf_dir)))


@query
def check_constraints(spark, sf_dir):
    rows = records.flatten_startup(_startups(spark, sf_dir), "seq")
    return _reasons(validate.check_constraints(rows, "startups"))


@query
def duplicate_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(text_of("https://n.example/", F.col("o_custkey")).alias("source_url"))
    return validate.duplicate_keys(rows, "news")


@query
def union_records(spark, sf_dir):
    """Startups and products as one frame of mixed records."""
    mixed = records.union_records(
        records.flatten_startup(_startups(spark, sf_dir), "seq"), records.flatten_product(_products(spark, sf_dir), "seq")
    )
    return mixed.select("seq", "record_type", "entity_name", "startup_name", "employee_count", "pricing_model", "source_url")


# -- storage --------------------------------------------------------------------------------------


def _paper_history(spark, sf_dir):
    """(snapshot, delta) of papers: older orders are stored rows, newer ones a batch full of gaps.

    A third of the batch falls on one key.
    """
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    stored = orders.where("o_orderkey % 4 = 0").groupBy("o_custkey").agg(F.min("o_orderkey").alias("k"))
    snapshot = stored.select(
        (F.col("k") + 1).alias("id"), F.lit("1.0").alias("schema_version"), F.lit("RESEARCH_PAPER").alias("record_type"),
        text_of("stored ", F.col("k")).alias("title"), F.array(F.lit("A"), F.lit("B")).alias("authors"),
        text_of("https://p.example/", F.col("o_custkey")).alias("paper_url"),
        F.when(F.col("k") % 8 == 0, "https://github.com/s/s").alias("github_url"),
        F.lit(3).alias("github_stars"), F.lit("2020-01-01T00:00:00Z").alias("published_date"),
        F.lit(BATCH_TS).alias("collected_at"),
    )
    hot = F.when(key % 3 == 0, 1).otherwise(F.col("o_custkey"))
    delta = orders.where("o_orderkey % 4 <> 0").select(
        key.alias("seq"), F.lit("1.0").alias("schema_version"), F.lit("RESEARCH_PAPER").alias("record_type"),
        every("o_orderkey", 5, nothing(), "", text_of("title ", key)).alias("title"),
        every("o_orderkey", 7, F.array(F.col("o_orderstatus")), F.array().cast("array<string>")).alias("authors"),
        text_of("https://p.example/", hot).alias("paper_url"),
        every("o_orderkey", 6, text_of("https://github.com/d/", key), nothing()).alias("github_url"),
        every("o_orderkey", 9, F.lit(0), (key % 1000).cast("int"), F.lit(None).cast("int")).alias("github_stars"),
        every("o_orderkey", 4, nothing(), F.date_format("o_orderdate", dates.ISO_OUTPUT)).alias("published_date"),
    )
    return snapshot, delta


@query
def upsert_papers(spark, sf_dir):
    snapshot, delta = _paper_history(spark, sf_dir)
    merged = upsert.upsert_papers(snapshot, delta)
    return merged.select("id", "seq", "paper_url", "title", text.join_authors(F.col("authors")).alias("authors"),
                         "github_url", "github_stars", "published_date")


def _keyed_postings(spark, sf_dir, kind):
    """Jobs or news keyed by customer, a third of them on one key."""
    side = "company_name" if kind == "JOB" else "content_summary"
    key = F.col("o_orderkey")
    hot = F.when(key % 3 == 0, 2).otherwise(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        key.alias("seq"), F.lit("1.0").alias("schema_version"), F.lit(kind).alias("record_type"),
        every("o_orderkey", 5, nothing(), "", text_of("t", key)).alias("title"),
        F.col("o_orderpriority").alias(side), F.lit("feed").alias("source_name"),
        text_of("https://n.example/", hot).alias("source_url"),
        F.date_format("o_orderdate", dates.ISO_OUTPUT).alias("published_date"),
        every("o_orderkey", 7, F.lit(None).cast("boolean"), key % 2 == 0).alias("is_fresh"),
    )


def _posting_history(spark, sf_dir, kind):
    """(snapshot, delta): a tenth of the postings makes the stored rows, the others are the batch."""
    rows = _keyed_postings(spark, sf_dir, kind)
    old = rows.where("seq % 10 = 1")
    old = old.join(old.groupBy("source_url").agg(F.min("seq").alias("seq")).select("seq"), "seq", "left_semi")
    snapshot = old.select((F.col("seq") + 1).alias("id"), *rows.columns).drop("seq").withColumns(
        {"title": F.coalesce("title", F.lit("stored")), "is_fresh": F.coalesce("is_fresh", F.lit(False))}
    )
    return snapshot, rows.where("seq % 10 <> 1")


@query
def upsert_jobs(spark, sf_dir):
    merged = upsert.upsert_jobs(*_posting_history(spark, sf_dir, "JOB"))
    return merged.select("id", "seq", "source_url", "company_name", "title", "published_date", "is_fresh")


@query
def upsert_news(spark, sf_dir):
    merged = upsert.upsert_news(*_posting_history(spark, sf_dir, "NEWS"))
    return merged.select("id", "seq", "source_url", "content_summary", "title", "published_date", "is_fresh")


@query
def assign_ids(spark, sf_dir):
    return upsert.assign_ids(table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 7).alias("seq")), start=1000)


def _store(spark) -> TableStore:
    store = TableStore(spark, scratch_dir(spark, "store"))
    store.create_tables()
    return store


@query
def append_startups(spark, sf_dir):
    """Validated startups appended in two batches, the second one twice under one batch name."""
    store = _store(spark)
    valid, _ = validate.split_valid(validate.validate_startups(_startups(spark, sf_dir)))
    rows = records.flatten_startup(valid, "seq")
    for part, batch in ((0, "a"), (1, "b"), (1, "b")):
        store.append_startups(rows.where(F.col("seq") % 2 == part), BATCH_TS, batch=batch)
    return store.read_table("startups").select("id", "entity_name", "employee_count", "source_url")


@query
def append_products(spark, sf_dir):
    store = _store(spark)
    jobs.run_products(store, _products(spark, sf_dir), BATCH_TS)
    return store.read_table("products").select("id", "startup_name", "pricing_model", "source_url")


@query
def append_entity_mappings(spark, sf_dir):
    store = _store(spark)
    mapped = resolve.resolve_entities(
        _raw_names(spark, sf_dir).withColumn("seq", F.col("p_partkey")), _part_names(spark, sf_dir), _aliases(spark, sf_dir)
    )
    store.append_entity_mappings(mapped, BATCH_TS)
    return store.read_table("entity_mappings").drop("created_at")


@query
def store_papers(spark, sf_dir):
    """Whole run: pages to stored papers with stars, in two batches over the same URLs."""
    store = _store(spark)
    pages = _paper_pages(spark, sf_dir).withColumn("error", nothing())
    stats = table(spark, sf_dir, "part").select(
        text_of("org", F.col("p_partkey") % 40).alias("owner"), F.regexp_replace("p_name", " ", "-").alias("repo"),
        F.lit(200).alias("status"), F.lit(7).alias("stargazers_count"),
    ).distinct()
    jobs.run_papers(store, pages.where("seq % 3 <> 0"), stats, AS_OF, BATCH_TS, batch="run#1")
    jobs.run_papers(store, pages, stats, AS_OF, BATCH_TS, batch="run#2")
    return store.read_table("research_papers").select("id", "paper_url", "title", "github_url", "github_stars", "published_date")


@query
def lookup_by_url(spark, sf_dir):
    """The stored news row of the customer with the most orders."""
    store = _store(spark)
    store.upsert_news(_keyed_postings(spark, sf_dir, "NEWS"), BATCH_TS)
    return store.lookup_by_url("https://n.example/2", "news").select("source_url", "title", "content_summary")


@query
def run_summary(spark, sf_dir):
    store = _store(spark)
    store.upsert_jobs(_keyed_postings(spark, sf_dir, "JOB"), BATCH_TS)
    store.append_products(records.flatten_product(_products(spark, sf_dir), "seq"), BATCH_TS)
    return store.run_summary().select("table_name", "n_rows", F.date_format("last_collected_at", "yyyy-MM-dd").alias("last_day"))


@query
def read_records(spark, sf_dir):
    """Raw products written as JSON lines with damaged ones among them, read back by schema."""
    path = scratch_dir(spark, "records")
    lines = F.when(F.col("seq") % 20 == 0, text_of('{"seq": ', F.col("seq"))).otherwise(F.to_json(F.struct("*")))
    _products(spark, sf_dir).select(lines.alias("value")).write.text(path)
    good, bad = inputs.read_records(spark, path, f"seq BIGINT, {schemas.RAW_PRODUCT}")
    counted = [part.agg(F.count("*").alias("n_rows")).withColumn("kind", F.lit(kind)) for part, kind in ((good, "good"), (bad, "bad"))]
    return records.union_records(*counted)


# -- exports --------------------------------------------------------------------------------------


def _export_rows(spark, sf_dir, name):
    key = F.col("c_custkey")
    columns = {
        "id": key, "schema_version": F.lit("1.0"), "record_type": F.lit(name), "title": F.col("c_name"),
        "authors": every("c_custkey", 3, F.array("c_mktsegment", "c_name"), F.array("c_name"), F.array().cast("array<string>")),
        "paper_url": text_of("https://p.example/", key), "github_url": nothing(), "github_stars": F.col("c_nationkey"),
        "published_date": F.lit("2024-01-01T00:00:00Z"), "entity_name": F.col("c_name"), "startup_name": F.col("c_name"),
        "company_name": F.col("c_mktsegment"), "content_summary": every("c_custkey", 2, 'says "a, b"', nothing()),
        "source_name": F.lit("feed"), "source_url": text_of("https://s.example/", key), "employee_count": F.col("c_nationkey"),
        "pricing_model": every("c_custkey", 2, "PAID", nothing()), "is_fresh": key % 2 == 0, "raw_name": F.col("c_name"),
        "canonical_name": F.upper("c_name"), "entity_type": F.lit("STARTUP"), "resolution_method": F.lit("fuzzy"),
        "confidence": F.lit(0.9), "collected_at": F.lit(BATCH_TS) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("c_acctbal").cast("decimal(12,6)")),
    }
    columns["created_at"] = columns["collected_at"]
    wanted = LAYOUTS[name]
    return table(spark, sf_dir, "customer").select(*[columns[c].alias(c) for c in wanted])


def _export_query(name):
    def build(spark, sf_dir):
        return export_layout(_export_rows(spark, sf_dir, name), name)

    build.__name__ = f"export_{name}"
    return query(build)


for _name in LAYOUTS:
    _export_query(_name)


@query
def export_csv(spark, sf_dir):
    """News written as CSV and read back as text columns: quotes, commas, nulls and booleans survive."""
    path = scratch_dir(spark, "csv")
    write_csv(export_layout(_export_rows(spark, sf_dir, "news"), "news"), path)
    columns = ", ".join(f"{c} STRING" for c in LAYOUTS["news"].values())
    back = spark.read.schema(columns).option("header", True).option("escape", '"').csv(path)
    return back.select("id", "title", "contentSummary", "publishedDate", "isFresh")


# -- model responses ------------------------------------------------------------------------------


def _responses(spark, sf_dir):
    """Three stored answers per conversation turn, good and bad by key."""
    turns = table(spark, sf_dir, "conversations")
    key = F.col("conv_id") * 1000 + F.col("turn")
    base = turns.select(key.alias("k"), text_of(key).alias("request_id"), F.to_json(F.struct(F.col("text").alias("name"))).alias("body"))
    parts = []
    for priority, provider in enumerate(("primary", "second", "third")):
        state = F.floor(F.col("k") / (3 ** priority)) % 3
        raw = (
            F.when(state == 0, text_of(" ```json\n", F.col("body"), "\n``` "))
            .when(state == 1, text_of("Sure! ", F.col("body")))
        )
        parts.append(base.select(
            "request_id", F.lit(provider).alias("provider"), F.lit(priority).alias("priority"),
            (F.col("k") % 5 != priority).alias("available"), raw.alias("raw_output"),
            F.when(state == 2, text_of("timeout after ", F.lit(priority + 1))).alias("error"),
        ))
    return records.union_records(*parts)


@query
def merge_extractions(spark, sf_dir):
    merged = responses.merge_extractions(_responses(spark, sf_dir))
    return merged.select("request_id", F.get_json_object("json", "$.name").alias("name"), "provider", "error")


@query
def collect_errors(spark, sf_dir):
    return responses.collect_errors(_responses(spark, sf_dir))


@query
def strip_code_fence(spark, sf_dir):
    fenced = every(
        "turn", 4, text_of("```json\n", F.col("text"), "\n```"), text_of("```", F.col("text"), "```"), text_of(" ```JSON  ", F.col("text")),
        F.col("text"),
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", record_columns.strip_code_fence(fenced).alias("body"))


@query
def parse_json_strict(spark, sf_dir):
    """Event properties, clean and damaged."""
    shown = every("event_id", 5, F.col("props"), text_of("[", F.col("props"), "]"), text_of(F.col("props"), " x"), text_of("'", F.col("props"), "'"), "")
    parsed = table(spark, sf_dir, "events").select("event_id", record_columns.parse_json_strict(shown).alias("p"))
    return parsed.select("event_id", "p.kind", F.get_json_object("p.json", "$.k").cast("int").alias("k"))


@query
def extract_with(spark, sf_dir):
    """Local stand-ins as providers: the first refuses long prompts, the second answers with JSON."""
    import json

    def short_only(prompt, system):
        if len(prompt) > 300:
            raise ValueError("prompt too long")
        return "```json\n" + json.dumps({"n": len(prompt)}) + "\n```"

    def long_only(prompt, system):
        return json.dumps({"n": len(prompt)}) if len(prompt) % 2 == 0 else "no idea"

    asked = table(spark, sf_dir, "conversations").select(
        text_of(F.col("conv_id"), "-", F.col("turn")).alias("request_id"), F.col("text").alias("prompt"), nothing().alias("system_prompt")
    )
    got = responses.extract_with(spread(asked), [("short", short_only), ("long", long_only)])
    return got.select("request_id", F.get_json_object("json", "$.n").cast("bigint").alias("n"), "provider", F.col("error").isNotNull().alias("failed"))


# -- streaming ------------------------------------------------------------------------------------


def _stream(spark, sf_dir, name):
    """One table of the folder as a stream."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _drain(stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over everything there is, into Parquet, and read that."""
    spark, path = stream.sparkSession, scratch_dir(stream.sparkSession, purpose)
    running = (
        stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _event_pages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("fetched_at"),
        text_of("https://E.example/", F.col("user_id"), "/", F.col("event_type"), "/?utm_id=", F.col("event_id")).alias("url"),
    )


@query
def stream_dedup_urls(spark, sf_dir):
    kept = streams.stream_dedup_urls(_event_pages(_stream(spark, sf_dir, "events")), "60 days")
    return _drain(kept, "dedup").select("normalized_url")


@query
def stream_dedup_exact(spark, sf_dir):
    """All events in three micro-batches, in the order of their numbers."""
    path, events = scratch_dir(spark, "dedup-exact"), table(spark, sf_dir, "events")
    third = F.floor(F.col("event_id") * 3 / (events.agg(F.max("event_id")).scalar() + 1))
    files = 4 * spark.sparkContext.defaultParallelism
    for part in range(3):  # each run takes the files that are new, of any number, in one micro-batch
        events.where(third == part).repartition(files).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        streams.dedup_into(_event_pages(arriving).select("seq", "url"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema("seq BIGINT, normalized_url STRING").parquet(f"{path}/out").select("seq", "normalized_url")


@query
def stream_fresh_only(spark, sf_dir):
    aged = text_of(F.floor("value").cast("int"), " hours ago")
    rows = _stream(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("fetched_at"), aged.alias("published_date"))
    return _drain(streams.stream_fresh_only(rows), "fresh").select("event_id", "published_date")


@query
def stream_freshness_summary(spark, sf_dir):
    """Days of events with their fresh rows, from three micro-batches; what comes behind the watermark is not counted."""
    path, events = scratch_dir(spark, "freshness"), table(spark, sf_dir, "events")
    third = F.floor(F.col("event_id") * 3 / (events.agg(F.max("event_id")).scalar() + 1))
    for part in range(3):
        events.where(third == part).coalesce(1).write.mode("append").parquet(f"{path}/in")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    aged = text_of(F.floor("value").cast("int"), " hours ago")
    rows = arriving.select("event_type", F.col("ts").cast("timestamp").alias("fetched_at"), aged.alias("published_date"))
    days = _drain(streams.stream_freshness_summary(rows, "event_type"), "freshness-days")
    return days.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n_rows", "n_fresh")


@query
def stream_upsert(spark, sf_dir):
    """News merged from a stream of orders; same answer as merging them at once."""
    store = _store(spark)
    key = F.col("o_orderkey")
    delta = _stream(spark, sf_dir, "orders").select(
        key.alias("seq"), F.lit("1.0").alias("schema_version"), F.lit("NEWS").alias("record_type"),
        every("o_orderkey", 5, nothing(), text_of("t", key)).alias("title"), F.col("o_orderpriority").alias("content_summary"),
        F.lit("feed").alias("source_name"), text_of("https://n.example/", F.col("o_custkey")).alias("source_url"),
        nothing().alias("published_date"), (key % 2 == 0).alias("is_fresh"),
    )
    running = streams.stream_upsert(
        delta, store, "news", upsert.NEWS, scratch_dir(spark, "upsert"), lambda batch_id: BATCH_TS
    )
    running.awaitTermination()
    return store.read_table("news").select("id", "source_url", "title", "content_summary", "is_fresh")


@query
def upsert_rejected(spark, sf_dir):
    """What an upsert of news in two batches could not store: the rows whose URL is null."""
    store = _store(spark)
    rows = _keyed_postings(spark, sf_dir, "NEWS").withColumn("source_url", F.when(F.col("seq") % 7 != 0, F.col("source_url")))
    for part in (0, 1):
        store.upsert_news(rows.where(F.col("seq") % 2 == part), BATCH_TS, batch=f"news#{part}")
    return store.read_rejected("news").select(
        "batch", F.array_join("reasons", ",").alias("reasons"), F.get_json_object("record", "$.seq").cast("bigint").alias("seq"),
        F.get_json_object("record", "$.title").alias("title"))


# -- headline -------------------------------------------------------------------------------------


@query
def site_titles(spark, sf_dir):
    """Distinct pages per site with and without a usable title: URL, dedup, parse and chain in one."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), "url", F.col("html").alias("content"))
    facts = html.html_facts(spread(pages), ["metas", "ld", "h1", "title"])
    unique = dedup.only_first(
        facts.select("seq", "url", text.truthy(extract.news_title()).alias("title")), dedup.first_arrivals(pages)
    )
    titled = unique.withColumn("host", urls.url_host(F.col("url")))
    return titled.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.count("title").alias("n_titled"), F.max(F.length("title")).alias("longest_title")
    )

