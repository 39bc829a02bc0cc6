"""Columns for record checks and model responses."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.text import bind, py_strip

# Fixed values.
PRICING_MODELS = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE")
JSON_INSTRUCTION = (
    "IMPORTANT: Return ONLY a valid JSON object matching the requested schema. "
    "Do NOT include markdown formatting or explanation. "
    "If information is missing in the provided source text, set the field value to null. "
    "Do NOT guess or fabricate data."
)


def valid_pricing(c: Column) -> Column:
    """Null is fine; otherwise the upper-cased value must be a known model."""
    return c.isNull() | F.upper(c).isin(*PRICING_MODELS)


def nonneg_int(c: Column) -> Column:
    return c.isNull() | (c >= 0)


FENCE, LANGUAGE = "```", "json"


def strip_code_fence(raw: Column) -> Column:
    """Text without a surrounding markdown code fence; null gives ''.

    A text that begins with the marker loses it, the language word if it stands right behind it, and the
    marker at its end if there is one.
    """

    def body(text: Column) -> Column:
        named = F.lower(F.substr(text, F.lit(len(FENCE) + 1), F.lit(len(LANGUAGE)))) == LANGUAGE
        begin = F.when(named, len(FENCE) + len(LANGUAGE)).otherwise(len(FENCE))
        return bind(py_strip(F.substr(text, begin + 1)), unclosed)

    def unclosed(inner: Column) -> Column:
        return F.when(inner.endswith(FENCE), py_strip(F.left(inner, F.length(inner) - len(FENCE)))).otherwise(inner)

    return F.coalesce(bind(py_strip(raw), lambda text: F.when(text.startswith(FENCE), body(text)).otherwise(text)), F.lit(""))


def build_prompt(system: Column) -> Column:
    """System text followed by the fixed instruction; without system text the instruction alone."""
    return F.concat_ws("\n", F.when(system != "", system), F.lit(JSON_INSTRUCTION))


def unfenced(answer: str | None) -> str:
    """`strip_code_fence` for one answer inside a task."""
    text = (answer or "").strip()
    if not text.startswith(FENCE):
        return text
    text = text[len(FENCE) :]
    named = text[: len(LANGUAGE)].lower() == LANGUAGE
    return text[len(LANGUAGE) * named :].strip().removesuffix(FENCE).strip()


def _refuse(constant: str) -> None:
    raise ValueError(f"{constant} is not JSON")


def strict_json(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(canonical JSON text, kind, None), or (None, None, what is wrong)."""
    try:
        value = json.loads(text or "", parse_constant=_refuse)
    except (ValueError, RecursionError) as problem:
        return None, None, str(problem)
    return json.dumps(value, ensure_ascii=False), type(value).__name__, None


_PARSED = T.StructType([T.StructField(name, T.StringType()) for name in ("json", "kind", "error")])


@F.pandas_udf(_PARSED)
def parse_json_strict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Strict parse: canonical JSON text and its kind, or the parser's message."""
    for batch in batches:
        yield pd.DataFrame([strict_json(text) for text in batch], columns=["json", "kind", "error"], dtype="object")
