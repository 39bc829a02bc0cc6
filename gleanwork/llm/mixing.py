"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are all wanted the same number of times, f = target / size of the source. Everyone is
taken floor(f) times; the rest f - floor(f) is a probability, and those are rounded to 0 or 1 dependently:
two documents meet, and words move from one to the other, at random which way, until one probability is 0
or 1. Moving words, not documents, keeps the source's expected words as they are, and each document's own
expectation too. What is left open in one chunk of a source (at most one document) meets the leftovers of
other chunks in a tree of fixed fan-in, so no source, however large, passes through one task. Documents
meet from the longest to the shortest, so what is left at the root is short and the source's words end
near their target.

Only numbers of sources, not of documents, reach the driver.

Defined results
---------------
* A document's size is the number of its words; null, empty and blank texts have size 0, take nothing and
  take no part in the rounding.
* Sources are ordered by code point, null last, and weigh `weights`, repeating. Targets are their shares of
  all words, at most `max_copies` times a source's size; what is above is shared out again by weight.
* Which documents are taken depends on id, source and text alone, through salted hashes: reruns agree,
  whatever the partitions. Rows that repeat an id are told apart by their text; rows alike in both are numbered.
* A null id is an id like any other. Empty tables give empty results. Further columns are kept by
  `mix_documents`, which repeats rows, and ignored by `mix_sources`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.session import staged

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
CHUNK_ROWS = 50_000  # documents of a source in one chunk, about
FAN_IN = 64  # leftovers that meet at one node of the tree, about


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Whoever is above the limit gets the limit, and the others share the rest by weight, until nobody is
    above. Each round is one aggregation over the sources; only two sums come back.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one narrow row per source
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    table = staged(sizes.select("source", "source_size", weight.alias("weight")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * max_copies
    per_weight, above = 0.0, F.lit(False)
    capped = -1
    while True:
        row = table.agg(
            F.sum(F.when(above, F.col("source_size"))).alias("held"), F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"),
        ).first()
        if row["n"] == capped:
            break
        capped = row["n"]
        per_weight = (total - max_copies * (row["held"] or 0)) / row["weights"] if row["weights"] else 0.0
        above = above | (F.col("weight") * per_weight > limit)
    target = F.when(above, limit.cast("double")).otherwise(F.col("weight") * per_weight)
    return table.select("source", "source_size", target.alias("target"))


def _uniform(*parts: object) -> float:
    """A number in [0, 1) that depends on `parts` alone."""
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big") / 2**64


def pivot(rid_a: int, p_a: float, size_a: int, rid_b: int, p_b: float, size_b: int, seed: str) -> tuple[float, float]:
    """New probabilities of two documents: words moved until one of them is 0 or 1."""
    to_a = min((1 - p_a) * size_a, p_b * size_b)
    to_b = min(p_a * size_a, (1 - p_b) * size_b)
    gives_b = _uniform(seed, rid_a, rid_b) * (to_a + to_b) < to_b
    moved, full_a, full_b = (to_a, (1 - p_a) * size_a, p_b * size_b) if gives_b else (-to_b, p_a * size_a, (1 - p_b) * size_b)
    # The one that is settled gets its whole number exactly, not by rounding of floats.
    if full_a <= full_b:
        return (1.0 if gives_b else 0.0), min(max(p_b - moved / size_b, 0.0), 1.0)
    return min(max(p_a + moved / size_a, 0.0), 1.0), (0.0 if gives_b else 1.0)


def _settle(seed: str, last: bool):
    """Rows of one partition, sorted by node, to (rid, node, p): settled ones and one leftover per node."""

    def left_over(node: str, rid: int, p: float, size: int) -> tuple[str, int, float, int, bool]:
        return (node, rid, float(_uniform(seed, "last", rid) < p), size, True) if last else (node, rid, p, size, False)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_row: tuple[str, int, float, int] | None = None
        for frame in frames:
            out: list[tuple[str, int, float, int, bool]] = []
            for node, rid, p, size in zip(frame["node"], frame["rid"], frame["p"], frame["size"]):
                if open_row is None or open_row[0] != node:
                    if open_row is not None:
                        out.append(left_over(*open_row))
                    open_row = (node, rid, p, size)
                    continue
                _, other, p_other, size_other = open_row
                p_other, p = pivot(other, p_other, size_other, rid, p, size, seed)
                first, second = (node, other, p_other, size_other), (node, rid, p, size)
                if p_other in (0.0, 1.0):
                    out.append((*first, True))
                    open_row = second
                else:
                    out.append((*second, True))
                    open_row = first
                if open_row[2] in (0.0, 1.0):  # both came out whole
                    out.append((*open_row, True))
                    open_row = None
            yield pd.DataFrame(out, columns=["node", "rid", "p", "size", "done"])
        if open_row is not None:
            yield pd.DataFrame([left_over(*open_row)], columns=["node", "rid", "p", "size", "done"])

    return run


def dependent_rounding(rows: DataFrame, seed: str = "mix", chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """(rid, extra) for `rows` (rid, group, p, size, group_rows) with 0 < p < 1 and size > 0.

    `rid` is any long that is the same on a rerun. Each round deals the open rows of a group to
    chunks by hash, settles all but one of each chunk, and hands those on to a coarser round.
    """
    spark = rows.sparkSession
    schema = "node string, rid bigint, p double, size bigint, done boolean"
    chunks = F.greatest(F.lit(1), F.ceil(F.col("group_rows") / chunk_rows)).cast("long")
    most = rows.agg(F.max(chunks)).first()[0] or 1
    # Chunk numbers are cut to ever coarser ones: every chunk of a group is below one root.
    node = F.col("group")
    current = rows.select("rid", "p", "size", node.alias("group"), F.pmod(F.xxhash64(F.lit(seed), "rid"), chunks).alias("chunk"))
    done: list[DataFrame] = []
    level = 0
    while True:
        last = most == 1
        named = current.select(F.concat_ws(":", F.col("group").cast("string"), F.col("chunk").cast("string")).alias("node"), "rid", "p", "size")
        dealt = named.repartition("node").sortWithinPartitions("node", F.col("size").desc(), F.xxhash64(F.lit(level), "rid"), "rid")
        result = staged(dealt.mapInPandas(_settle(f"{seed}:{level}", last), schema), "rounded")
        done.append(result.where("done").select("rid", F.col("p").cast("long").alias("extra")))
        if last:
            break
        parts = F.split("node", ":")
        current = result.where("not done").select(
            "rid", "p", "size", parts[0].alias("group"), F.floor(parts[1].cast("long") / fan_in).alias("chunk"))
        most = -(-most // fan_in)
        level += 1
    settled = done[0]
    for part in done[1:]:
        settled = settled.unionAll(part)
    return settled if done else spark.createDataFrame([], "rid bigint, extra bigint")


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = "mix",
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per document: `key`, size, source_size, target (of its source), copies, taken."""
    narrow = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
                         F.xxhash64(F.col(f"`{text}`")).alias("print"))
    # Rows alike in id, source and text are numbered, so that a row's number does not depend on partitions.
    twin = F.row_number().over(Window.partitionBy("id", "source", "print").orderBy("size"))
    rows = staged(narrow.withColumn("twin", twin).withColumn("rid", F.xxhash64("id", "source", "print", "twin")), "sizes")
    grouped = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("group_rows"))
    targets = source_targets(grouped.select("source", "source_size"), weights, max_copies)
    per_source = staged(
        targets.join(grouped.select("source", "group_rows"), targets["source"].eqNullSafe(grouped["source"])).select(
            targets["source"].alias("of"), "source_size", "target", "group_rows",
            F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0).alias("f"),
        ).withColumn("group", F.xxhash64("of")), "targets")
    # One row per source against the documents: Spark broadcasts it where it is small and splits hot sources where not.
    full = rows.join(per_source, rows["source"].eqNullSafe(per_source["of"])).drop("of")
    whole = F.floor("f")
    loose = full.where((F.col("size") > 0) & (F.col("f") > whole)).select("rid", "group", (F.col("f") - whole).alias("p"), "size", "group_rows")
    extra = dependent_rounding(loose, seed, chunk_rows)
    copies = F.when(F.col("size") > 0, F.floor("f") + F.coalesce("extra", F.lit(0))).otherwise(0).cast("long")
    return full.join(extra, "rid", "left").select(
        F.col("id").alias(key), "source", "print", "twin", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed rows: each document as often as it is taken, with all its columns."""
    verdict = mix_sources(docs, key, text, source, **options).where("copies > 0").select(
        F.col(f"`{key}`").alias("id"), F.col("source").alias("of"), F.col("print").alias("of_text"), "twin", "copies")
    # Rows alike in all columns may change places, others not.
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    numbered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{key}`").alias("k"),
        F.col(f"`{source}`").alias("s"), F.xxhash64(F.col(f"`{text}`")).alias("p"), whole.alias("w"),
    ).withColumn("t", F.row_number().over(Window.partitionBy("k", "s", "p").orderBy("w")))
    same = F.col("k").eqNullSafe(F.col("id")) & F.col("s").eqNullSafe(F.col("of")) & (F.col("p") == F.col("of_text")) & (F.col("t") == F.col("twin"))
    return numbered.join(verdict, same).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
