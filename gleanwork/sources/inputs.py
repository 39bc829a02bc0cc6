"""Reading pages, raw records and lookup tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork import schemas


def spread(scan: DataFrame) -> DataFrame:
    """A plain file scan with at least one partition per core.

    Parsing pages costs far more than reading them, and a small file is one split. Large inputs
    have more splits than cores already and are left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages fetched beforehand, as Parquet."""
    return spread(spark.read.schema(schemas.PAGES).parquet(path))


def read_fetch_attempts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FETCH_ATTEMPTS).parquet(path)


def read_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(readable raw records, unreadable lines) of a JSON-lines folder."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json("value", f"{schema}, _corrupt_record STRING", options)
    rows = spark.read.text(path).where(F.trim("value") != "").select("value", parsed.alias("record"))
    broken = F.col("record._corrupt_record").isNotNull()
    return rows.where(~broken).select("record.*").drop("_corrupt_record"), rows.where(broken).select("value")


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALIASES).parquet(path)


def read_canonicals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CANONICALS).parquet(path)


def read_repo_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPO_STATS).parquet(path)
