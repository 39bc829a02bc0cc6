"""Joins that add outside facts to records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.repos import github_owner_repo, repo_url
from gleanwork.functions.text import py_strip, truthy
from gleanwork.operators.lookup import lookup_join


def enrich_repo_stars(papers: DataFrame, stats: DataFrame, url: str = "github_url", stars: str = "github_stars") -> DataFrame:
    """Canonical repository URL and star count from a `repo_stats` snapshot.

    No usable answer (repository missing, status other than 200) gives null stars; a URL that is no
    repository link stays as it is.
    """
    link = github_owner_repo(F.col(url))
    keyed = papers.withColumn("_repo", F.when(link.isNotNull(), repo_url(link["owner"], link["repo"])))
    answers = (
        stats.groupBy(repo_url(F.col("owner"), F.col("repo")).alias("_repo"))
        .agg(F.max(F.when(F.col("status") == 200, F.col("stargazers_count"))).alias("_stars"))
    )
    joined = lookup_join(keyed, answers, "_repo")
    return joined.withColumns(
        {url: F.coalesce("_repo", truthy(F.col(url))), stars: F.col("_stars").cast("int")}
    ).select(*dict.fromkeys((*papers.columns, stars)))


def canonicalize_ref(records: DataFrame, mappings: DataFrame, name: str) -> DataFrame:
    """Replace the column `name` by its resolved canonical name where one is known.

    `mappings` holds `raw_name`, `canonical_name`; of several rows for one name the latest `id`
    counts, if there is such a column.
    """
    order = F.col("id") if "id" in mappings.columns else F.col("canonical_name")
    known = mappings.groupBy(py_strip(F.col("raw_name")).alias("_raw")).agg(
        F.max_by("canonical_name", order).alias("_canonical")
    )
    joined = lookup_join(records.withColumn("_raw", py_strip(F.col(name))), known, "_raw")
    return joined.withColumn(name, F.coalesce("_canonical", name)).select(*records.columns)
