"""Declared schemas, as DDL text. Nothing in this package infers one."""

from __future__ import annotations

_SOURCE = "source STRUCT<name: STRING, url: STRING>"


PAGES = (
    "seq BIGINT, url STRING, normalized_url STRING, status_code INT, content STRING, "
    "headers MAP<STRING, STRING>, error STRING, elapsed_seconds DOUBLE, is_playwright BOOLEAN, "
    "fetched_at TIMESTAMP, source_name STRING"
)
FETCH_ATTEMPTS = (
    "url STRING, attempt INT, status INT, retry_after STRING, content STRING, "
    "headers MAP<STRING, STRING>, exception STRING, elapsed_seconds DOUBLE"
)
PAPER = (
    "schemaVersion STRING, recordType STRING, title STRING, authors ARRAY<STRING>, "
    "paper_url STRING, github_url STRING, github_stars INT, published_date STRING"
)
NEWS = (
    f"schemaVersion STRING, recordType STRING, title STRING, content_summary STRING, {_SOURCE}, "
    "published_date STRING, is_fresh BOOLEAN"
)
JOB = (
    f"schemaVersion STRING, recordType STRING, company_name STRING, title STRING, {_SOURCE}, "
    "published_date STRING, is_fresh BOOLEAN"
)
RAW_STARTUP = (
    "schemaVersion STRING, recordType STRING, "
    f"content STRUCT<entityName: STRING, data: STRUCT<employeeCount: INT>>, {_SOURCE}"
)
RAW_PRODUCT = (
    "schemaVersion STRING, recordType STRING, "
    f"content STRUCT<startupName: STRING, pricingModel: STRING>, {_SOURCE}"
)
ALIASES = "norm STRING, canonical STRING"
CANONICALS = "pos INT, name STRING"
REPO_STATS = "owner STRING, repo STRING, status INT, stargazers_count INT"
RESPONSES = (
    "request_id STRING, provider STRING, priority INT, available BOOLEAN, raw_output STRING, error STRING"
)

# Stored tables: name -> schema. `collected_at` is stamped per batch.
_HEAD = "id BIGINT, schema_version STRING, record_type STRING"
TABLES: dict[str, str] = {
    "sources": "id BIGINT, name STRING, url STRING, collected_at TIMESTAMP",
    "research_papers": (
        f"{_HEAD}, title STRING, authors ARRAY<STRING>, paper_url STRING, github_url STRING, "
        "github_stars INT, published_date STRING, collected_at TIMESTAMP"
    ),
    "startups": (
        f"{_HEAD}, entity_name STRING, source_name STRING, source_url STRING, employee_count INT, "
        "collected_at TIMESTAMP"
    ),
    "products": (
        f"{_HEAD}, startup_name STRING, source_name STRING, source_url STRING, pricing_model STRING, "
        "collected_at TIMESTAMP"
    ),
    "jobs": (
        f"{_HEAD}, company_name STRING, title STRING, source_name STRING, source_url STRING, "
        "published_date STRING, is_fresh BOOLEAN, collected_at TIMESTAMP"
    ),
    "news": (
        f"{_HEAD}, title STRING, content_summary STRING, source_name STRING, source_url STRING, "
        "published_date STRING, is_fresh BOOLEAN, collected_at TIMESTAMP"
    ),
    "entity_mappings": (
        "id BIGINT, raw_name STRING, canonical_name STRING, entity_type STRING, source_url STRING, "
        "resolution_method STRING, confidence DOUBLE, created_at TIMESTAMP"
    ),
    "crawl_jobs": (
        "id BIGINT, job_id STRING, source_url STRING, status STRING, error_message STRING, "
        "created_at TIMESTAMP"
    ),
}

# Columns that must hold a value, and the key that must be unique, per stored table.
_ALWAYS = ("schema_version", "record_type")
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "sources": ("name", "url"),
    "research_papers": (*_ALWAYS, "paper_url"),
    "startups": (*_ALWAYS, "entity_name", "source_name", "source_url"),
    "products": (*_ALWAYS, "startup_name", "source_name", "source_url"),
    "jobs": (*_ALWAYS, "company_name", "title", "source_name", "source_url", "is_fresh"),
    "news": (*_ALWAYS, "title", "source_name", "source_url", "is_fresh"),
    "entity_mappings": ("raw_name", "canonical_name", "entity_type", "resolution_method", "confidence"),
    "crawl_jobs": ("job_id", "source_url", "status"),
}
UNIQUE_KEY: dict[str, str] = {
    "sources": "url",
    "research_papers": "paper_url",
    "jobs": "source_url",
    "news": "source_url",
}
