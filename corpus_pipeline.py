"""Documents to token pieces in five stages: clean, drop copies, drop near copies, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before, which is written as
Parquet and read again in between. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import exact_dedup, minhash, mixing, pieces, quality_rules
from gleanwork.session import ensure_settings, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the lines that failed are gone from the others, and n_chars follows."""
    judged = quality_rules.kept_documents(docs.select(*COLUMNS))
    changed = F.col("quality.n_removed_lines") > 0
    text = F.when(changed, F.col("quality.cleaned_text")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.length("quality.cleaned_text").cast("long")).otherwise(F.col("n_chars"))
    return judged.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs.select(*COLUMNS))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return minhash.drop_near_duplicates(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents leave or repeat so that sources have their shares of the words."""
    return mixing.mix_documents(docs.select(*COLUMNS))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and two sampled segmentations."""
    return pieces.encode_and_sample(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

# Signatures, dependent rounding and sampling are not SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ensure_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
