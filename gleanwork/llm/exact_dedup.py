"""Exact dedup with a heavy-hitter split.

A frequent-items sketch (a mergeable Misra-Gries summary of fixed size) over 64-bit fingerprints finds
every digest that may hold a large share of the rows. Those candidates are counted exactly; the ones
that do hold the share are the winners, at most `HOT_SHARE` of them. The winners are broadcast, so rows
with a hot digest get their verdict where they are read and never move. All other digests, each with
less than that share of the rows, meet in an ordinary shuffle of narrow rows.

Defined results
---------------
* A null text counts as the empty text; all empty texts are one group.
* The row with the largest id stays. A null id is smaller than any other. Rows that repeat the winning
  id are told apart by their place in the staged table, so exactly one row of a group is kept.
* Texts are equal when their SHA-256 is; nothing is normalised, and texts of any length are hashed whole.
* An empty table gives an empty result. Further columns are ignored by `exact_dedup` and kept by
  `drop_exact_copies`, whatever their names: working columns are made inside one struct or renamed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.session import staged

# A digest is hot when it holds at least 1/HOT_SHARE of all rows, so at most HOT_SHARE are broadcast.
HOT_SHARE = 1000
# Counters of the sketch. It misses no digest with more than about 5/TRACKED of the rows.
TRACKED = 16384


def digest(text: Column) -> Column:
    """SHA-256 of the whole text as 32 bytes, null as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, digest, rid): one narrow row per document; `rid` is a fixed number of the row."""
    rows = docs.select(F.col(key).alias("id"), digest(F.col(text)).alias("digest"))
    return staged(rows.withColumn("rid", F.monotonically_increasing_id()), "digests")


def hot_digests(prints: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """(digest, n, keep_id, keep_rid) of the at most `share` digests with 1/`share` of the rows each."""
    tracked = max(TRACKED, 16 * share)
    sketch = F.expr(f"approx_top_k(xxhash64(digest), {2 * share}, {tracked})")
    summary = staged(prints.agg(F.count("*").alias("total"), sketch.alias("items")), "sketch")
    # Whatever the sketch says, a winner is verified by its exact count over all rows.
    candidates = summary.select(F.explode("items.item").alias("print"))
    counted = (
        prints.withColumn("print", F.xxhash64("digest"))
        .join(F.broadcast(candidates), "print", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("id", "rid")).alias("top"))
    )
    total = summary.select("total").scalar()
    winners = counted.where((F.col("n") > 1) & (F.col("n") * share >= total))
    return staged(winners.select("digest", "n", F.col("top.id").alias("keep_id"), F.col("top.rid").alias("keep_rid")), "hot")


def _verdicts(prints: DataFrame, hot: DataFrame) -> DataFrame:
    """(id, digest, keep_id, n, kept) for every row of `prints`."""
    marked = prints.join(F.broadcast(hot), "digest", "left")
    direct = marked.where(F.col("n").isNotNull())
    group = Window.partitionBy("digest")
    cold = (
        prints.join(F.broadcast(hot), "digest", "left_anti")
        .withColumn("top", F.max(F.struct("id", "rid")).over(group))
        .withColumn("n", F.count("*").over(group))
        .withColumn("keep_id", F.col("top.id"))
        .withColumn("keep_rid", F.col("top.rid"))
    )
    order = ["id", "digest", "keep_id", "n", (F.col("rid") == F.col("keep_rid")).alias("kept")]
    return direct.select(order).unionAll(cold.select(order))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = HOT_SHARE) -> DataFrame:
    """One row per document: `key`, keep_id, group_size, kept, text_sha256 (lower-case hex)."""
    prints = fingerprints(docs, key, text)
    return _verdicts(prints, hot_digests(prints, share)).select(
        F.col("id").alias(key), "keep_id", F.col("n").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = HOT_SHARE) -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns.

    Copies with a hot digest go before anything is shuffled; the other rows meet their group's winner
    by digest.
    """
    prints = fingerprints(docs, key, text)
    hot = hot_digests(prints, share)
    stay = _verdicts(prints, hot).where("kept").select("digest", F.col("id").alias("stay_id"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), digest(F.col(text)).alias("digest"))
    small = F.broadcast(hot.select("digest", F.lit(True).alias("hot"), F.col("keep_id").alias("hot_id")))
    alive = (
        rows.join(small, "digest", "left")
        .where(F.col("hot").isNull() | F.col(f"doc.`{key}`").eqNullSafe(F.col("hot_id")))
        .select("doc", "digest")
    )
    met = alive.join(stay, "digest").where(F.col(f"doc.`{key}`").eqNullSafe(F.col("stay_id")))
    # Rows that repeat id and text are the same record: one of them is left.
    nth = F.row_number().over(Window.partitionBy("digest").orderBy(F.xxhash64("doc")))
    return met.withColumn("nth", nth).where("nth = 1").select("doc.*")
