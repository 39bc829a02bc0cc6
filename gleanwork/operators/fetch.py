"""Final outcome per URL from a log of fetch attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RETRIES = 4
# Twins of one attempt number that are told apart.
TWINS = 1 << 32


def _error_text(last: Column, max_retries: int) -> Column:
    """Fixed formats of the error per status."""
    status = last["status"]
    return (
        F.when(status.isNull(), last["exception"])
        .when(status == 200, None)
        .when(status == 429, f"HTTP 429: Too Many Requests (exceeded {max_retries} retries)")
        .when(status == 413, "HTTP 413: Payload Too Large")
        .when(status.between(500, 599), F.concat(F.lit("HTTP "), status, F.lit(" server error")))
        .otherwise(F.concat(F.lit("HTTP status "), status))
    )


def fetch_outcome(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """One row per URL: the first attempt that settles it, else the last one that was due.

    429, 5xx and network errors settle nothing, every other status settles the URL at once. The whole
    log can settle a URL, attempts beyond `max_retries` (counted from 0) too; `retryable` marks URLs
    whose log ends unsettled before that attempt. Of attempts with the same number any one counts.
    """
    status = F.col("status")
    again = status.isNull() | (status == 429) | status.between(500, 599)
    # Attempts are told apart by their number, twins of one number by a hash: one long per attempt, so the fold is
    # a hash aggregation of three numbers, and no page text enters it.
    content = F.xxhash64("status", "content", "exception", "elapsed_seconds")
    named = attempts.withColumn("_attempt", F.col("attempt").cast("bigint") * TWINS + F.pmod(content, F.lit(TWINS)))
    number, due = F.col("_attempt"), F.col("attempt") <= max_retries
    folded = named.groupBy("url").agg(
        F.min(F.when(~again, number)).alias("settled"), F.max(F.when(due, number)).alias("latest"), F.max(number).alias("beyond"))
    chosen = folded.select(
        F.col("url").alias("_url"), F.coalesce("settled", "latest", "beyond").alias("_chosen"), F.col("settled").isNotNull().alias("_settled"))
    met = named.join(chosen, F.col("url").eqNullSafe(F.col("_url")) & (number == F.col("_chosen")))
    # An attempt that is logged twice is one; only settled ones have content worth carrying.
    row = F.struct("attempt", "status", F.when(F.col("_settled"), F.col("content")).alias("content"), "headers", "exception", "elapsed_seconds")
    picked = met.groupBy("url").agg(F.collect_list(F.struct("_settled", row.alias("row"))).alias("rows"))
    last = F.col("rows")[0]["row"]
    return picked.select(
        "url",
        last["status"].alias("status_code"),
        F.when(last["status"] == 200, last["content"]).alias("content"),
        last["headers"].alias("headers"),
        _error_text(last, max_retries).alias("error"),
        last["elapsed_seconds"].alias("elapsed_seconds"),
        (last["attempt"] + 1).alias("attempts"),
        (~F.col("rows")[0]["_settled"] & (last["attempt"] < max_retries)).alias("retryable"),
    )
