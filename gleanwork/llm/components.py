"""Links inside buckets without all pairs, and connected components, both on distributed tables.

`linked` verifies few pairs of a bucket and loses no link between components: every member is first
compared with one leader of its bucket, so that a group of real copies falls into one component with one
comparison each; large buckets get a few more leaders. Members that are still in different components are then met under
finer keys, if the caller has some: keys of which any two linked members share at least one.

`components` contracts stars (large-star and small-star in turn): every round is two aggregations with
map-side combining and two joins, a hot vertex is an ordinary row of each, and rounds grow with the logarithm
of the longest chain. Links found later are laid over the labels known so far (`merged`). All intermediate tables lie in the shared folder; no link reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

LEADER_ROUNDS = 2
# Buckets with more open members than this get further leaders. It decides about the order of comparisons alone.
HOT_MEMBERS = 64


def _is_forest(edges: DataFrame) -> bool:
    """Whether every item has one edge at most and leads to an item without one: then labels are found."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("v").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1 and out > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(item, label): the smallest item reachable, for every item that has a link.

    `edges` holds longs a, b in either direction; loops, nulls and repeats are harmless.
    """
    edges = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_forest(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Edges that come out twice go with the next `distinct`; there are no more of them than before.
        large = staged(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = edges.select(F.col("b").alias("item")).distinct()
    return edges.select(F.col("a").alias("item"), F.col("b").alias("label")).unionAll(roots.select("item", F.col("item").alias("label")))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (item, label) after further `links` (a, b): only the graph of the labels is looked at."""
    of = labels.select(F.col("item").alias("of"), "label")
    ends = links.join(of, links["a"] == of["of"], "left").select(F.coalesce("label", "a").alias("a"), "b")
    ends = ends.join(of, ends["b"] == of["of"], "left").select("a", F.coalesce("label", "b").alias("b"))
    moved = staged(components(ends), "moved")
    to = moved.select(F.col("item").alias("label"), F.col("label").alias("to"))
    old = labels.join(to, "label", "left").select("item", F.coalesce("to", "label").alias("label"))
    return old.unionAll(moved.join(labels, "item", "left_anti").select("item", "label"))


def linked(members: DataFrame, verify: Callable[[DataFrame], DataFrame], finer: Callable[[DataFrame], DataFrame] | None = None,
           may_link: Callable[[str, str], Column] | None = None, prepare: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """(item, label) of the components that `verify` finds inside buckets.

    `members` has (bucket, item), both longs; `verify` takes distinct pairs (a, b), a < b, and returns those
    that are links. The labels are those of all links inside buckets, although not every link is looked
    at: pairs that are already in one component need no look. `prepare` is called once with the items that
    may be asked about. What is open after the leader rounds is handed to `finer` as a table of items, which gives
    members (bucket, item, and what `may_link` needs) under keys that any two linked items of the table share; then pairs of
    different components that share a key are looked at, where `may_link` of the two rows (given the prefixes of their
    columns) holds; it must hold for one key of every link. Without `finer` all open pairs of a bucket are looked at.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("item").alias("low"), F.max("item").alias("high"))
    sizes = sizes.where("low <> high")
    # Members go through two shuffles of narrow rows; only those of buckets with company go on.
    shared = staged(members.join(sizes, "bucket").select("bucket", "item", "n", "low"), "members")
    if prepare:
        prepare(shared.select("item").distinct())
    first = shared.where("item <> low").select(F.col("low").alias("a"), F.col("item").alias("b")).distinct()
    links = staged(verify(first), "links")
    labels = staged(components(links), "labels")

    def still_open(rows: DataFrame) -> DataFrame:
        """(bucket, item, label, n) of the buckets that hold more than one component."""
        marked = rows.join(labels, "item", "left").select("bucket", "item", F.coalesce("label", "item").alias("label"))
        mixed = marked.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("n"))
        return staged(marked.join(mixed.where("l <> h").select("bucket", "n"), "bucket").select("bucket", "item", "label", "n"), "open")

    def across(rows: DataFrame) -> DataFrame:
        """All pairs of a bucket that are in different components."""
        other = rows.select("bucket", F.col("item").alias("b"), F.col("label").alias("label_b"))
        return rows.withColumnRenamed("item", "a").join(other, "bucket").where("a < b and label <> label_b").select("a", "b")

    open_ = still_open(shared.where("n > 2").select("bucket", "item"))
    for round_ in range(LEADER_ROUNDS):
        hot = open_.where(F.col("n") > HOT_MEMBERS)
        if hot.isEmpty():
            break
        # The leader of this round is any member, drawn by hash.
        lead = hot.groupBy("bucket").agg(F.min_by(F.struct("item", "label"), F.xxhash64(F.lit(round_), "item")).alias("lead"))
        met = hot.join(lead, "bucket").where("label <> lead.label")
        pairs = met.select(F.least("item", "lead.item").alias("a"), F.greatest("item", "lead.item").alias("b")).distinct()
        links = staged(verify(pairs), "links")
        if links.isEmpty():  # a leader without a single copy: more of them would not pay
            break
        labels = staged(merged(labels, links), "labels")
        open_ = still_open(open_.select("bucket", "item"))
    if open_.isEmpty():
        return labels
    if finer:
        keyed = finer(staged(open_.select("item").distinct(), "open-items"))
        rows = staged(keyed.join(labels, "item", "left").withColumn("label", F.coalesce("label", "item")), "keyed")
        mixed = rows.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("bucket")
        rows = rows.join(mixed, "bucket", "left_semi")
        left, right = (rows.select("bucket", *[F.col(c).alias(s + c) for c in rows.columns if c != "bucket"]) for s in ("a_", "b_"))
        met = left.join(right, "bucket").where(F.expr("a_item < b_item and a_label <> b_label"))
        pairs = (met.where(may_link("a_", "b_")) if may_link else met).select(F.col("a_item").alias("a"), F.col("b_item").alias("b"))
    else:
        pairs = across(open_)
    pairs = staged(pairs.distinct(), "pairs")
    links = staged(verify(pairs), "links")
    return labels if links.isEmpty() else staged(merged(labels, links), "labels")
