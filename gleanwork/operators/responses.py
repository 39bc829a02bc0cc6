"""Merging model responses by provider priority, stored or produced by callables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.records import parse_json_strict, strict_json, strip_code_fence, unfenced
from gleanwork.functions.text import truthy

# The texts an unsuccessful request is reported with.
NO_PROVIDER = "No LLM providers available or configured."
ALL_FAILED = "LLM Extraction failed across all providers: "


def _failed(provider: Column, why: Column) -> Column:
    return F.concat(F.lit("LLM provider '"), provider, F.lit("' failed: "), why)


def _not_json(provider: Column, why: Column) -> Column:
    return F.concat(F.lit("Failed to parse JSON response from "), provider, F.lit(": "), why)


def merge_extractions(responses: DataFrame, require_object: bool = False) -> DataFrame:
    """Per request the first available response, by priority, that is valid JSON, with its provider.

    Requests without one get the errors of all available providers, joined in priority order.
    `require_object=True` counts only JSON objects as success.
    """
    parsed = responses.withColumn(
        "parsed",
        F.when(F.col("available") & F.col("error").isNull(), parse_json_strict(strip_code_fence(F.col("raw_output")))),
    )
    json_text = F.col("parsed.json")
    if require_object:
        json_text = F.when(F.col("parsed.kind") == "dict", json_text)
    ok = F.col("available") & json_text.isNotNull()
    why = F.coalesce(
        truthy(F.col("error")),
        _not_json(F.col("provider"), F.coalesce("parsed.error", F.lit("not an object"))),
    )
    tried = F.col("available") & ~F.coalesce(ok, F.lit(False))
    folded = parsed.groupBy("request_id").agg(
        F.min_by(F.struct(json_text.alias("json"), "provider"), F.when(ok, F.col("priority"))).alias("hit"),
        F.collect_list(F.when(tried, F.struct("priority", _failed(F.col("provider"), why).alias("text")))).alias("misses"),
    )
    return _report(folded)


def _report(folded: DataFrame) -> DataFrame:
    """(request_id, json, provider, error) from the first hit and the misses."""
    texts = F.transform(F.array_sort("misses"), lambda m: m["text"])
    errors = F.when(F.size(texts) > 0, F.array_join(texts, "; ")).otherwise(NO_PROVIDER)
    return folded.select(
        "request_id",
        F.col("hit.json").alias("json"),
        F.col("hit.provider").alias("provider"),
        F.when(F.col("hit").isNull(), F.concat(F.lit(ALL_FAILED), errors)).alias("error"),
    )


def collect_errors(responses: DataFrame) -> DataFrame:
    """(request_id, error) of the requests no provider answered."""
    return merge_extractions(responses).where(F.col("error").isNotNull()).select("request_id", "error")


Provider = tuple[str, Callable[[str, str | None], str]]


def extract_with(requests: DataFrame, providers: Sequence[Provider]) -> DataFrame:
    """Ask callables in order, per row (request_id, prompt, system_prompt), inside tasks.

    The next provider is asked only where the earlier ones failed, so each rung of the chain sees
    the rows still open. Output as in `merge_extractions`.
    """
    chain = list(providers)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(r.request_id, *_ask_one(chain, r.prompt, r.system_prompt)) for r in batch.itertuples()],
                columns=["request_id", "json", "provider", "error"],
                dtype="object",
            )

    picked = requests.select(F.col("request_id").cast("string").alias("request_id"), "prompt", "system_prompt")
    return picked.mapInPandas(ask, "request_id string, json string, provider string, error string")


def _ask_one(chain: list[Provider], prompt: str, system: str | None) -> tuple[str | None, str | None, str | None]:
    misses = []
    for name, call in chain:
        try:
            answer = unfenced(call(prompt, system))
        except Exception as problem:  # a provider may fail in any way
            misses.append(f"LLM provider '{name}' failed: {problem}")
            continue
        parsed, _, wrong = strict_json(answer)
        if wrong is None:
            return parsed, name, None
        misses.append(f"LLM provider '{name}' failed: Failed to parse JSON response from {name}: {wrong}")
    return None, None, ALL_FAILED + ("; ".join(misses) or NO_PROVIDER)
