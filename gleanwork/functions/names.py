"""Entity names: normal form and similarity."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.text import SPACE_CLASS, py_strip

# Legal-form words that do not tell companies apart.
LEGAL_WORDS = (
    "inc", "incorporated", "llc", "corp", "corporation", "co", "company",
    "ltd", "limited", "gmbh", "plc", "pvt",
)
_WORD = r"\p{L}\p{N}_"
_LEGAL = rf"(?<![{_WORD}])(?:{'|'.join(LEGAL_WORDS)})(?![{_WORD}])"


def normalize_entity_name(name: Column) -> Column:
    """Lower case, no punctuation, no legal words, single blanks; null gives ''."""
    text = F.regexp_replace(F.lower(py_strip(name)), rf"[^{_WORD}{SPACE_CLASS}]", "")
    text = F.regexp_replace(text, _LEGAL, "")
    text = F.regexp_replace(text, rf"[{SPACE_CLASS}]+", " ")
    return F.coalesce(F.btrim(text), F.lit(""))


_SCORE = T.StructType([T.StructField(name, T.DoubleType()) for name in ("ratio", "rounded")])


@F.pandas_udf(_SCORE)
def sequence_score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Share of matched characters, 2M/T, of name `a` against candidate `b`, also to two digits.

    The rounding is done here because it must see the exact binary value: decimal rounding in SQL
    settles ties such as 37/40 differently. The matcher indexes `b`, so it is kept while
    consecutive rows share the candidate.
    """
    matcher, indexed = SequenceMatcher(None), None
    for left, right in batches:
        scores = []
        for a, b in zip(left, right):
            if a is None or b is None:
                scores.append((None, None))
                continue
            if b != indexed:
                matcher.set_seq2(b)
                indexed = b
            matcher.set_seq1(a)
            ratio = matcher.ratio()
            scores.append((ratio, round(ratio, 2)))
        yield pd.DataFrame(scores, columns=["ratio", "rounded"], dtype="float64")


def sequence_ratio(a: Column | str, b: Column | str) -> Column:
    return sequence_score(a, b)["ratio"]
