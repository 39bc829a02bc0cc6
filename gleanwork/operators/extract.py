"""Field chains over page facts: papers, news, jobs.

Each field is a `coalesce` over its sources in order of trust. A source that is present but blank
ends the chain with an empty value; only an absent one hands over to the next.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.dates import format_iso_utc, fresh_at, parse_timestamp
from gleanwork.functions.repos import github_url_clean
from gleanwork.functions.text import SPACE_CLASS, py_strip, strip_title_prefix, truthy
from gleanwork.operators.html import html_facts

SCHEMA_VERSION = "1.0"

# The names of the sources, and the defaults for records without a value.
PAPER_DATE_METAS = ("citation_date", "citation_online_date", "citation_publication_date")
NEWS_DATE_METAS = ("article:published_time", "og:article:published_time", "pubdate")
SUBMITTED_ON = rf"(?i)Submitted on[{SPACE_CLASS}]+([0-9]{{1,2}}[{SPACE_CLASS}]+[A-Za-z]+[{SPACE_CLASS}]+[0-9]{{4}})"
JOB_TYPE = "JobPosting"
NO_NEWS_TITLE = "Untitled News"
NO_COMPANY = "Unknown Company"
NO_JOB_TITLE = "Unknown Title"
NEWS_SOURCE = "AI News"
JOB_SOURCE = "AI Jobs"

PAPER_FACTS = ("metas", "h1_titled", "title", "author_links", "dateline", "repo_href", "raw_repo_url")
NEWS_FACTS = ("metas", "ld", "h1", "title", "time_datetime")
JOB_FACTS = ("metas", "ld", "h1", "time_datetime")


def _raw_meta(kind: str, key: str) -> Column:
    """Content of the first matching meta, '' where it has none, null where there is no such meta."""
    matches = F.filter("metas", lambda m: m[kind] == key)
    return F.when(F.size(matches) > 0, F.coalesce(F.try_element_at(matches, F.lit(1))["content"], F.lit("")))


def meta_content(kind: str, key: str) -> Column:
    """Trimmed content of the first `<meta property=…>` or `<meta name=…>`; null if absent or empty."""
    return py_strip(truthy(_raw_meta(kind, key)))


def _first(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _first_dated(texts: Column, as_of) -> Column:
    """First of the texts that parses as a date; those behind it are not looked at. One lambda, however many
    sources: the parser is a large expression, and a `coalesce` of copies would outgrow generated code."""
    return F.aggregate(texts, F.lit(None).cast("timestamp"), lambda found, t: F.coalesce(found, parse_timestamp(t, as_of)))


# -- papers ---------------------------------------------------------------------------------------


def paper_title() -> Column:
    return F.coalesce(
        meta_content("name", "citation_title"),
        strip_title_prefix(F.col("h1_titled")),
        strip_title_prefix(truthy(F.col("title"))),
    )


def paper_authors() -> Column:
    listed = F.transform(
        F.filter("metas", lambda m: (m["name"] == "citation_author") & (m["content"] != "")),
        lambda m: py_strip(m["content"]),
    )
    return F.when(F.size(listed) > 0, listed).otherwise(F.col("author_links"))


def paper_published(as_of) -> Column:
    submitted = F.regexp_extract(F.col("dateline"), SUBMITTED_ON, 1)
    metas = [_raw_meta("name", name) for name in PAPER_DATE_METAS]
    return _first_dated(F.array(*metas, submitted), as_of)


def paper_github_url(compat: bool = False) -> Column:
    return github_url_clean(F.coalesce("repo_href", "raw_repo_url"), compat)


# -- news -----------------------------------------------------------------------------------------


def news_title() -> Column:
    named = F.filter(
        F.transform("ld", lambda i: F.coalesce(truthy(i["headline"]), truthy(i["name"]))), F.isnotnull
    )
    return F.coalesce(
        meta_content("property", "og:title"),
        py_strip(_first(named)),
        F.col("h1"),
        py_strip(truthy(F.col("title"))),
    )


def news_summary() -> Column:
    described = F.filter(F.transform("ld", lambda i: truthy(i["description"])), F.isnotnull)
    return F.coalesce(
        meta_content("property", "og:description"),
        meta_content("name", "description"),
        py_strip(_first(described)),
    )


def news_published(as_of) -> Column:
    metas = [F.coalesce(_raw_meta("property", key), _raw_meta("name", key)) for key in NEWS_DATE_METAS]
    dated = F.flatten(F.transform("ld", lambda i: F.array(i["date_published"], i["date_created"])))
    return _first_dated(F.concat(F.array(*metas), dated, F.array("time_datetime")), as_of)


# -- jobs -----------------------------------------------------------------------------------------


def job_posting_ld() -> Column:
    """struct(title, company, posted) of the page's postings.

    The first posting of a script counts and a later script overrides an earlier one: its title
    always, its company where it names an organisation at all, its date where it has one.
    """
    postings = F.filter("ld", lambda i: i["type"] == JOB_TYPE)
    numbers = F.array_distinct(F.transform(postings, lambda i: i["script_no"]))
    leading = F.transform(numbers, lambda n: _first(F.filter(postings, lambda i: i["script_no"] == n)))
    last = lambda items: F.try_element_at(items, F.lit(-1))
    return F.struct(
        last(leading)["title"].alias("title"),
        last(F.filter(leading, lambda i: i["org_kind"].isNotNull()))["org_name"].alias("company"),
        last(F.filter(leading, lambda i: i["date_posted"].isNotNull()))["date_posted"].alias("posted"),
    )


def job_title(posting: Column) -> Column:
    return F.coalesce(truthy(posting["title"]), meta_content("property", "og:title"), F.col("h1"))


def job_company(posting: Column) -> Column:
    return F.coalesce(
        truthy(posting["company"]), meta_content("property", "og:site_name"), meta_content("name", "author")
    )


def job_published(posting: Column, as_of) -> Column:
    """A `<time datetime>` that does not parse ends the chain."""
    meta = F.coalesce(_raw_meta("name", "datePosted"), _raw_meta("property", "article:published_time"))
    return _first_dated(F.array(posting["posted"], F.coalesce("time_datetime", meta)), as_of)


# -- records --------------------------------------------------------------------------------------


def _source(df: DataFrame, url: str, default: str) -> Column:
    name = F.coalesce("source_name", F.lit(default)) if "source_name" in df.columns else F.lit(default)
    return F.struct(name.alias("name"), F.col(url).alias("url")).alias("source")


def _kept(df: DataFrame, keep: tuple[str, ...], url: str) -> DataFrame:
    wanted = dict.fromkeys((*keep, url, *(["source_name"] if "source_name" in df.columns else []), "content"))
    return df.select(*wanted)


def extract_papers(
    pages: DataFrame, as_of: datetime | Column, keep: tuple[str, ...] = (), url: str = "url", compat: bool = False
) -> DataFrame:
    """Paper records from pages (`url`, `content`); the columns in `keep` ride along in front."""
    facts = html_facts(_kept(pages, keep, url), PAPER_FACTS)
    return facts.select(
        *keep,
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("RESEARCH_PAPER").alias("recordType"),
        paper_title().alias("title"),
        paper_authors().alias("authors"),
        F.col(url).alias("paper_url"),
        paper_github_url(compat).alias("github_url"),
        F.lit(None).cast("int").alias("github_stars"),
        format_iso_utc(paper_published(as_of)).alias("published_date"),
    )


def extract_news(
    pages: DataFrame, as_of: datetime | Column, keep: tuple[str, ...] = (), url: str = "url"
) -> DataFrame:
    """News records from pages (`url`, `content`, optional `source_name`)."""
    facts = html_facts(_kept(pages, keep, url), NEWS_FACTS)
    dated = facts.withColumn("published_at", news_published(as_of))
    return dated.select(
        *keep,
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("NEWS").alias("recordType"),
        F.coalesce(truthy(news_title()), F.lit(NO_NEWS_TITLE)).alias("title"),
        news_summary().alias("content_summary"),
        _source(facts, url, NEWS_SOURCE),
        format_iso_utc("published_at").alias("published_date"),
        fresh_at(F.col("published_at"), as_of).alias("is_fresh"),
    )


def extract_jobs(
    pages: DataFrame, as_of: datetime | Column, keep: tuple[str, ...] = (), url: str = "url"
) -> DataFrame:
    """Job records from pages (`url`, `content`, optional `source_name`)."""
    facts = html_facts(_kept(pages, keep, url), JOB_FACTS).withColumn("posting", job_posting_ld())
    posting = F.col("posting")
    dated = facts.withColumn("published_at", job_published(posting, as_of))
    return dated.select(
        *keep,
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("JOB").alias("recordType"),
        F.coalesce(truthy(job_company(posting)), F.lit(NO_COMPANY)).alias("company_name"),
        F.coalesce(truthy(job_title(posting)), F.lit(NO_JOB_TITLE)).alias("title"),
        _source(facts, url, JOB_SOURCE),
        format_iso_utc("published_at").alias("published_date"),
        fresh_at(F.col("published_at"), as_of).alias("is_fresh"),
    )
