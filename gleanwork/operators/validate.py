"""Record rules as columns, with a quarantine instead of a halt.

Every rule of a record kind is evaluated; the failed ones are listed, in rule order, in `reasons`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.records import nonneg_int, valid_pricing
from gleanwork.functions.text import truthy
from gleanwork.functions.urls import valid_url
from gleanwork.schemas import REQUIRED_COLUMNS, UNIQUE_KEY

Rule = tuple[str, Column]


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _record_type(kind: str) -> Rule:
    return "recordType", _sure(F.col("recordType") == kind)


def _source_url() -> Rule:
    return "source.url", valid_url(F.col("source.url"))


def paper_rules() -> list[Rule]:
    link = truthy(F.col("github_url"))
    return [
        _record_type("RESEARCH_PAPER"),
        ("paper_url", valid_url(F.col("paper_url"))),
        ("github_url", link.isNull() | valid_url(link)),
        ("github_stars", nonneg_int(F.col("github_stars"))),
    ]


def startup_rules() -> list[Rule]:
    return [
        _record_type("STARTUP"),
        _source_url(),
        ("content.entityName", _sure(F.col("content.entityName") != "")),
        ("content.data.employeeCount", nonneg_int(F.col("content.data.employeeCount"))),
    ]


def product_rules() -> list[Rule]:
    return [
        _record_type("PRODUCT"),
        _source_url(),
        ("content.startupName", _sure(F.col("content.startupName") != "")),
        ("content.pricingModel", valid_pricing(F.col("content.pricingModel"))),
    ]


def job_rules() -> list[Rule]:
    return [_record_type("JOB"), _source_url()]


def news_rules() -> list[Rule]:
    return [_record_type("NEWS"), _source_url()]


RULES = {
    "papers": paper_rules, "startups": startup_rules, "products": product_rules,
    "jobs": job_rules, "news": news_rules,
}


def with_reasons(df: DataFrame, rules: list[Rule], fail_fast: bool = False) -> DataFrame:
    """Add `reasons`. With `fail_fast` the first broken record stops the job instead."""
    broken = F.array_compact(F.array(*[F.when(~ok, name) for name, ok in rules]))
    if fail_fast:
        message = F.concat(F.lit("invalid record: "), F.array_join(broken, ", "))
        broken = F.when(F.size(broken) > 0, F.raise_error(message).cast("array<string>")).otherwise(broken)
    return df.withColumn("reasons", broken)


def validate_papers(df: DataFrame, fail_fast: bool = False) -> DataFrame:
    return with_reasons(df, paper_rules(), fail_fast)


def validate_startups(df: DataFrame, fail_fast: bool = False) -> DataFrame:
    return with_reasons(df, startup_rules(), fail_fast)


def validate_products(df: DataFrame, fail_fast: bool = False) -> DataFrame:
    return with_reasons(df, product_rules(), fail_fast)


def validate_jobs(df: DataFrame, fail_fast: bool = False) -> DataFrame:
    return with_reasons(df, job_rules(), fail_fast)


def validate_news(df: DataFrame, fail_fast: bool = False) -> DataFrame:
    return with_reasons(df, news_rules(), fail_fast)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without `reasons`, rejected rows with them)."""
    clean = F.size("reasons") == 0
    return checked.where(clean).drop("reasons"), checked.where(~clean)


def validation_summary(checked: DataFrame) -> DataFrame:
    """Rows per broken rule; a row that breaks two rules counts for both."""
    return checked.select(F.explode("reasons").alias("rule")).groupBy("rule").agg(F.count("*").alias("n_rows"))


def check_constraints(rows: DataFrame, table: str) -> DataFrame:
    """Rows of a stored table with `reasons` naming the required columns that hold null."""
    rules = [(f"{c} is null", F.col(c).isNotNull()) for c in REQUIRED_COLUMNS[table]]
    return with_reasons(rows, rules)


def duplicate_keys(rows: DataFrame, table: str) -> DataFrame:
    """Key values of a stored table that occur more than once, with their count."""
    key = UNIQUE_KEY[table]
    return rows.groupBy(key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
