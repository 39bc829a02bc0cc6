"""The whole runs: pages to stored papers, news and jobs; raw records to startups and products.

Each run stages what its Python stage made before several passes read it, validates, quarantines
what failed, and merges the rest. Nothing runs until the store writes.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.operators import dedup, enrich, extract, records, resolve, validate
from gleanwork.session import staged
from gleanwork.sources.export import export_all
from gleanwork.sources.store import TableStore


def usable(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Of the records extracted from `pages`: first arrival per canonical URL, failed fetches dropped.

    The dedup looks at all pages, since a failed first fetch still stands for its URL. It is applied
    after extraction, so that the join moves records and never page text; later arrivals usually
    carry no content and cost the parser nothing.
    """
    return dedup.drop_failed(dedup.only_first(found, dedup.first_arrivals(pages))).drop("error")


def run_papers(
    store: TableStore, pages: DataFrame, repo_stats: DataFrame, as_of: datetime | Column, batch_ts: datetime,
    batch: str | None = None,
) -> DataFrame:
    """Pages to stored papers; returns the rejected records with their reasons."""
    found = staged(usable(extract.extract_papers(pages, as_of, keep=("seq", "error")), pages), "papers")
    checked = validate.validate_papers(enrich.enrich_repo_stars(found, repo_stats))
    valid, rejected = validate.split_valid(staged(checked, "papers-checked"))
    store.upsert_papers(records.flatten_paper(valid, "seq"), batch_ts, batch=batch)
    return rejected


def run_news(
    store: TableStore, pages: DataFrame, as_of: datetime | Column, batch_ts: datetime, batch: str | None = None
) -> DataFrame:
    checked = validate.validate_news(usable(extract.extract_news(pages, as_of, keep=("seq", "error")), pages))
    valid, rejected = validate.split_valid(staged(checked, "news"))
    store.upsert_news(records.flatten_news(valid, "seq"), batch_ts, batch=batch)
    return rejected


def run_jobs(
    store: TableStore, pages: DataFrame, as_of: datetime | Column, batch_ts: datetime, batch: str | None = None
) -> DataFrame:
    checked = validate.validate_jobs(usable(extract.extract_jobs(pages, as_of, keep=("seq", "error")), pages))
    valid, rejected = validate.split_valid(staged(checked, "jobs"))
    store.upsert_jobs(records.flatten_job(valid, "seq"), batch_ts, batch=batch)
    return rejected


def run_startups(
    store: TableStore, startups: DataFrame, canonicals: DataFrame, batch_ts: datetime,
    aliases: DataFrame | None = None, batch: str | None = None,
) -> DataFrame:
    """Raw startups (with `seq`) to mappings and stored startups under canonical names."""
    valid, rejected = validate.split_valid(validate.validate_startups(startups))
    names = valid.select(
        "seq",
        F.col("content.entityName").alias("raw_name"),
        F.lit("STARTUP").alias("entity_type"),
        F.col("source.url").alias("source_url"),
    )
    mappings = staged(resolve.resolve_entities(names, canonicals, aliases), "mappings")
    store.append_entity_mappings(mappings, batch_ts, batch=batch)
    rows = records.flatten_startup(valid, "seq")
    store.append_startups(enrich.canonicalize_ref(rows, mappings, "entity_name"), batch_ts, batch=batch)
    return rejected


def run_products(
    store: TableStore, products: DataFrame, batch_ts: datetime, batch: str | None = None
) -> DataFrame:
    """Raw products (with `seq`) stored under the canonical names known from the mappings so far."""
    valid, rejected = validate.split_valid(validate.validate_products(products))
    rows = records.flatten_product(valid, "seq")
    known = store.read_table("entity_mappings")
    store.append_products(enrich.canonicalize_ref(rows, known, "startup_name"), batch_ts, batch=batch)
    return rejected


def finish(store: TableStore, export_folder: str) -> tuple[dict[str, str], DataFrame]:
    """CSV exports of all tables, and the summary of the run."""
    return export_all(store, export_folder), store.run_summary()
