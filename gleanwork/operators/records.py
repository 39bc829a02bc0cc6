"""Nested records to flat table rows, and mixed records in one frame."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.dates import utc_literal
from gleanwork.operators.extract import SCHEMA_VERSION


def _head(kind: str) -> list[Column]:
    return [
        F.coalesce("schemaVersion", F.lit(SCHEMA_VERSION)).alias("schema_version"),
        F.coalesce("recordType", F.lit(kind)).alias("record_type"),
    ]


def _source() -> list[Column]:
    return [F.col("source.name").alias("source_name"), F.col("source.url").alias("source_url")]


def flatten_paper(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep, *_head("RESEARCH_PAPER"), "title",
        F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
        "paper_url", "github_url", "github_stars", "published_date",
    )


def flatten_startup(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep, *_head("STARTUP"), F.col("content.entityName").alias("entity_name"), *_source(),
        F.col("content.data.employeeCount").alias("employee_count"),
    )


def flatten_product(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep, *_head("PRODUCT"), F.col("content.startupName").alias("startup_name"), *_source(),
        F.col("content.pricingModel").alias("pricing_model"),
    )


def flatten_job(df: DataFrame, *keep: str) -> DataFrame:
    """Title, company and freshness stay null where absent; `upsert_jobs` knows their defaults."""
    return df.select(*keep, *_head("JOB"), "company_name", "title", *_source(), "published_date", "is_fresh")


def flatten_news(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *_head("NEWS"), "title", "content_summary", *_source(), "published_date", "is_fresh")


def stamp_collected_at(df: DataFrame, batch_ts: datetime | Column, column: str = "collected_at") -> DataFrame:
    """The batch's ingestion time, given by the caller so that a replay writes the same rows."""
    return df.withColumn(column, utc_literal(batch_ts))


def union_records(*frames: DataFrame) -> DataFrame:
    """Records of several kinds in one frame; columns a kind lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
