"""CSV layouts of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import join_authors
from gleanwork.sources.store import TableStore

# Output columns in order, stored name -> exported name.
_HEAD = {"id": "id", "schema_version": "schemaVersion", "record_type": "recordType"}
_SOURCE = {"source_name": "sourceName", "source_url": "sourceUrl"}
_DATED = {"published_date": "publishedDate", "is_fresh": "isFresh", "collected_at": "collectedAt"}
LAYOUTS: dict[str, dict[str, str]] = {
    "research_papers": {
        **_HEAD,
        **{c: c for c in (
            "title", "authors", "paper_url", "github_url", "github_stars", "published_date", "collected_at",
        )},
    },
    "startups": {
        **_HEAD, "entity_name": "entityName", **_SOURCE,
        "employee_count": "employeeCount", "collected_at": "collectedAt",
    },
    "products": {
        **_HEAD, "startup_name": "startupName", **_SOURCE,
        "pricing_model": "pricingModel", "collected_at": "collectedAt",
    },
    "jobs": {**_HEAD, "company_name": "companyName", "title": "title", **_SOURCE, **_DATED},
    "news": {**_HEAD, "title": "title", "content_summary": "contentSummary", **_SOURCE, **_DATED},
    "entity_mappings": {
        "id": "id", "raw_name": "rawName", "canonical_name": "canonicalName", "entity_type": "entityType",
        "source_url": "sourceUrl", "resolution_method": "resolutionMethod", "confidence": "confidence",
        "created_at": "createdAt",
    },
}
_STAMPS = ("collected_at", "created_at")


def _iso_stamp(ts: Column) -> Column:
    """ISO text; the fraction is shown only where there is one."""
    fraction = F.when(F.date_trunc("second", ts) != ts, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def export_layout(rows: DataFrame, table: str) -> DataFrame:
    """The rows of a stored table in the columns of its CSV file."""

    def shown(column: str) -> Column:
        if column == "authors":
            return join_authors(F.col(column))
        if column in _STAMPS:
            return F.coalesce(_iso_stamp(F.col(column)), F.lit(""))
        return F.col(column)

    return rows.select(*[shown(stored).alias(name) for stored, name in LAYOUTS[table].items()])


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """RFC 4180 quoting, header line, rows by id. One file only on request: it passes through one task."""
    ordered = rows.orderBy("id")
    target = ordered.coalesce(1) if single_file else ordered
    (
        target.write.mode("errorifexists")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_all(store: TableStore, folder: str, single_file: bool = False) -> dict[str, str]:
    """Write every layout under `folder`; returns table -> path."""
    written = {}
    for table in LAYOUTS:
        path = f"{folder.rstrip('/')}/{table}"
        write_csv(export_layout(store.read_table(table), table), path, single_file)
        written[table] = path
    return written
