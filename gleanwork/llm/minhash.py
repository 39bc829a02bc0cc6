"""Near-dedup by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its five-word shingles. Two permutations give all signature coordinates: the
first sends a shingle to a slot of a circle, the second ranks the slots, and coordinate k is the smallest
rank among the shingle slots after the circle is turned by k. Bands of `ROWS` coordinates are bucket keys.
Two sets at the threshold of 0.75 miss all 32 bands of 4 with a chance of about 5 in a million, sets that
are more alike with far less.

Equal sets are folded to one item before banding, so exact copies cost nothing further. Inside buckets
`components.linked` compares what is needed for the components; every link is confirmed on the full sets.

A very frequent passage fills some buckets with documents that have little else in common. What is still open
in a bucket after the leader rounds is met again under prefix keys: of a set of n shingles, sorted by how many open sets
hold them, the n - ceil(0.75 n) + 1 rarest. Two sets at the threshold share one of these, whatever else they hold,
so no link of a bucket is lost; and a passage that many sets share is in hardly any prefix. Where it is, the places of the shared
shingle in both orders bound what the sets can share, and pairs that cannot reach the threshold are not made.

Defined results
---------------
* A-Z are lower-cased; words are runs of characters other than blank, tab, line feed, vertical tab, form
  feed and return. Fewer than five words: the whole sequence is the one shingle. Null, empty or blank
  texts have an empty set, link with nothing and are their own component.
* Shingles and sets are compared by hashes of 64 and 128 bits of their words.
* A component's id is its smallest non-null id; a document is kept when its id is the component's. Rows
  without an id are kept only where they are alone, with a null component.
* Repeated rows are one component. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.llm.components import linked
from gleanwork.session import scratch_dir, staged

WORDS = 5
THRESHOLD = 75  # per cent
SLOTS = 1 << 20
BANDS, ROWS = 32, 4
SEED = 20240229
# Bytes of text that are hashed at once, so that a batch of long texts needs no more memory.
BLOCK_BYTES = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """Shingle sets and signatures of texts, in NumPy; the tables depend on the seed alone."""

    def __init__(self, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.words, self.bands, self.rows = words, bands, rows
        self.letters = rng.integers(1, 2**64, 256, np.uint64)
        self.base = rng.integers(1, 2**64, 1, np.uint64)[0] | np.uint64(1)
        self.steps = rng.integers(1, 2**64, words, np.uint64) | np.uint64(1)
        ranks = rng.permutation(SLOTS).astype(np.uint32)
        k = bands * rows
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[: k - 1]]), k)
        self.band_steps = rng.integers(1, 2**64, (bands, rows), np.uint64) | np.uint64(1)
        self.powers = self.inverse = np.ones(1, np.uint64)
        self._grow(BLOCK_BYTES)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = 1 << (n - 1).bit_length()
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, self.base)]), dtype=np.uint64)
            back = np.uint64(pow(int(self.base), -1, 2**64))
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, back)]), dtype=np.uint64)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        out: list[np.ndarray] = []
        block: list[bytes] = []
        size = 0
        for text in texts:
            block.append(text)
            size += len(text) + 1
            if size >= BLOCK_BYTES:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block) if block else out

    def _block(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join(texts).translate(_LOWER) + b" ", np.uint8)
        ends_at = np.cumsum([len(t) + 1 for t in texts])
        self._grow(len(data) + 1)
        space = _SPACE[data]
        word = ~space
        starts = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
        ends = np.flatnonzero(space & np.concatenate([[False], word[:-1]]))
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=prefix[1:])
        hashes = mixed((prefix[ends] - prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        first = np.searchsorted(starts, np.concatenate([[0], ends_at[:-1]]))
        last = np.searchsorted(starts, ends_at)
        n = self.words
        count = max(len(hashes) - n + 1, 0)
        rows = np.zeros(count, np.uint64)
        for j in range(n):
            rows += mixed(hashes[j : j + count] + np.uint64(j)) * self.steps[j]
        rows = mixed(rows)
        sets = []
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a >= n:
                sets.append(np.unique(rows[a : b - n + 1]))
            elif b > a:
                short = hashes[a:b]
                total = sum((mixed(short + np.uint64(97)) * self.steps[: b - a]).tolist()) + b - a
                sets.append(mixed(np.array([total % 2**64], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
        return sets

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """The bucket keys of a set, one per band."""
        slots = (mixed(shingles) >> np.uint64(44)).astype(np.int64)
        low = self.windows[slots[:4096]].min(axis=0)
        for i in range(4096, len(slots), 4096):
            low = np.minimum(low, self.windows[slots[i : i + 4096]].min(axis=0))
        folded = (mixed(low.reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)) * self.band_steps).sum(axis=1, dtype=np.uint64)
        return mixed(folded + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()).to_pylist()]


def set_digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _signatures(options: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(*options)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = hasher.sets(_texts(part))
                keys = [hasher.keys(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("id")), part.column(part.schema.get_field_index("print")),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_digest(s) for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "print", "n_shingles", "digest", "keys"])

    return run


def _shingle_sets(options: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(*options)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets, digests = hasher.sets(_texts(part)), part.column(part.schema.get_field_index("digest")).to_pylist()
                meant = [i for i, s in enumerate(sets) if set_digest(s) == digests[i]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("item")).take(pa.array(meant, pa.int64())),
                     pa.array([sets[i].view(np.int64) for i in meant], pa.list_(pa.int64()))], ["item", "shingles"])

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                    words: int = WORDS, bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """One row per document: `key`, n_shingles, component_id, kept. `threshold` is in per cent."""
    options = (words, bands, rows, seed)
    source = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("print"), F.col(f"`{text}`").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    signed = source.mapInArrow(_signatures(options), f"id {id_type}, print bigint, n_shingles bigint, digest binary, keys array<bigint>")
    signed = staged(signed.withColumn("rid", F.monotonically_increasing_id()), "signatures")

    # Equal sets are one item, named by the smallest row number.
    sets = staged(
        signed.where("digest is not null").groupBy("digest").agg(
            F.min("rid").alias("item"), F.min("id").alias("low_id"), F.max("n_shingles").alias("size")), "sets")
    members = signed.join(sets.select(F.col("item").alias("rid")), "rid").select(F.explode("keys").alias("bucket"), F.col("rid").alias("item"))
    holder = signed.select(F.col("rid").alias("item"), F.col("id").alias("holder"), F.col("print").alias("held"), "digest")
    table = f"shingles_{uuid.uuid4().hex}"
    spark = docs.sparkSession

    def prepare(items: DataFrame) -> None:
        """Write the shingle sets that may be compared, bucketed by item: joins by item move the pairs only."""
        wanted = items.join(holder, "item")
        # A row is told by id and text together, so rows that share an id, or have none, do not meet each other.
        texts = source.join(wanted, (F.col("print") == F.col("held")) & F.col("id").eqNullSafe(F.col("holder"))).select("item", "digest", "text")
        built = texts.mapInArrow(_shingle_sets(options), "item bigint, shingles array<bigint>")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        built.repartition(parts, "item").dropDuplicates(["item"]).write.bucketBy(parts, "item").option("compression", "zstd").option(
            "path", scratch_dir(spark, "shingles")).saveAsTable(table)

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets overlap enough."""
        size = sets.select("item", "size")
        near = (
            pairs.join(size.select(F.col("item").alias("a"), F.col("size").alias("size_a")), "a")
            .join(size.select(F.col("item").alias("b"), F.col("size").alias("size_b")), "b")
            .where(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * threshold)
        )
        full = spark.table(table)
        left = full.select(F.col("item").alias("a"), F.col("shingles").alias("x"))
        right = full.select(F.col("item").alias("b"), F.col("shingles").alias("y"))
        # Of two sets, the intersection decides: union = both sizes less the intersection.
        return (
            near.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
            .where(F.col("common") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("common")) * threshold)
            .select("a", "b")
        )

    def prefixes(items: DataFrame) -> DataFrame:
        """(bucket, item, size, behind): the rarest shingles of each set, as many as any link must share one of.

        `behind` counts the shingles of the set from this one on, in the common order.
        """
        open_sets = spark.table(table).join(items, "item", "left_semi")
        rows = open_sets.select("item", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
        held = rows.groupBy("shingle").agg(F.count("*").alias("n_sets")).where("n_sets > 1")
        common = rows.join(held, "shingle").groupBy("item").agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("n_sets", "shingle"))).alias("common"))
        # Shingles of a single set come first in the order and meet nothing.
        least = F.ceil(F.col("n") * threshold / 100).cast("int")
        wanted = F.greatest(F.col("n") - least + 1 - (F.col("n") - F.size("common")), F.lit(0))
        placed = common.select("item", F.col("n").alias("size"), F.size("common").alias("shared"), F.posexplode(F.slice("common", F.lit(1), wanted)).alias("place", "key"))
        return placed.select(F.col("key.shingle").alias("bucket"), "item", "size", (F.col("shared") - F.col("place")).alias("behind"))

    def may_link(a: str, b: str) -> Column:
        """Of a link's shared shingles one is the first in the order: all that two sets share stands from there on."""
        most = F.least(F.col(f"{a}behind"), F.col(f"{b}behind"))
        return most * (100 + threshold) >= (F.col(f"{a}size") + F.col(f"{b}size")) * threshold

    labels = linked(members, verify, prefixes, may_link, prepare)
    known = sets.join(labels, "item", "left").select("digest", F.coalesce("label", "item").alias("label"), "low_id")
    known = staged(known, "known")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    lowest = known.groupBy("label").agg(F.min("low_id").alias("component_id"))
    named = known.join(lowest, "label").select("digest", "component_id")
    # Rows without a set have a null digest, match nothing and stay alone.
    return signed.select("id", "n_shingles", "digest").join(named, "digest", "left").select(
        F.col("id").alias(key), "n_shingles",
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns.

    Ids name documents here: rows that repeat an id share its fate, and of those that repeat its text as
    well one stays.
    """
    dropped = near_duplicates(docs, key, text, **options).where("not kept").select(F.col(f"`{key}`").alias("gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{key}`").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("print"))
    stay = rows.join(dropped, rows["k"].eqNullSafe(dropped["gone"]), "left_anti")
    nth = F.row_number().over(Window.partitionBy("k", "print").orderBy(F.xxhash64("doc")))
    return stay.withColumn("nth", nth).where("nth = 1").select("doc.*")
