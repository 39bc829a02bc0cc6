"""Keyed merges of new records into a stored snapshot, and row ids.

A batch is first folded to one row per key, in arrival order (`seq`, unique per row). The fold works on arrival
numbers alone: per key the first one, and per changing column the newest one with a usable value. These are
numbers of fixed width, so they are hash-aggregated and combined before the shuffle: a key that makes up a third of the
batch arrives as one row per map task, and no text is sorted or carried along. The few rows that won something then give their
values. The merge joins two sides that are unique per key.

Rows without a key cannot be merged. `split_keyed` sets them apart; a fold that meets one fails.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.functions.text import truthy


@dataclass(frozen=True)
class MergeRule:
    """How the columns of one table change when a key comes again.

    `filled` columns take the newest value that is not blank, `present` columns the newest that is
    not null, all others keep the first value. `defaults` fill nulls of a row stored for the first time.
    """

    key: str
    filled: tuple[str, ...] = ()
    present: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)


PAPERS = MergeRule("paper_url", filled=("title", "authors", "github_url", "published_date"), present=("github_stars",))
JOBS = MergeRule(
    "source_url", present=("title", "is_fresh"),
    defaults={"company_name": "Unknown", "title": "Unknown", "is_fresh": False},
)
NEWS = MergeRule("source_url", present=("title", "is_fresh"), defaults={"title": "Untitled", "is_fresh": False})


def _usable(column: str, rule: MergeRule, df: DataFrame) -> Column:
    """The value where it may replace an older one, else null."""
    c = F.col(column)
    if column in rule.present:
        return c
    if df.schema[column].dataType.simpleString().startswith("array"):
        return F.when(F.size(c) > 0, c)
    return truthy(c)


def split_keyed(delta: DataFrame, rule: MergeRule) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without one with `reasons`)."""
    lost = delta.where(F.col(rule.key).isNull())
    return delta.where(F.col(rule.key).isNotNull()), lost.withColumn("reasons", F.array(F.lit(f"{rule.key} is null")))


def winning_seqs(delta: DataFrame, rule: MergeRule, seq: str = "seq") -> DataFrame:
    """(key, first_seq, newest): per key the first arrival, and per changing column the newest usable one."""
    changing = [c for c in delta.columns if c in (*rule.filled, *rule.present)]
    key = F.coalesce(rule.key, F.raise_error(F.lit(f"{rule.key} is null: set such rows apart with split_keyed")))
    newest = [F.max(F.when(_usable(c, rule, delta).isNotNull(), F.col(seq))).alias(f"_{i}") for i, c in enumerate(changing)]
    folded = delta.groupBy(key.alias(rule.key)).agg(F.min(seq).alias("first_seq"), *newest)
    won = [F.col(f"_{i}").alias(c) for i, c in enumerate(changing)]
    return folded.select(rule.key, "first_seq", F.struct(*won).alias("newest"))


def fold_delta(delta: DataFrame, rule: MergeRule, seq: str = "seq") -> DataFrame:
    """One row per key: `first` = its first row, `newest` = the newest usable value per changing
    column, `first_seq` = its arrival. A null key fails the run: see `split_keyed`.

    `delta` is read twice: stage it if it is expensive."""
    columns = [c for c in delta.columns if c not in (rule.key, seq)]
    changing = [c for c in columns if c in (*rule.filled, *rule.present)]
    won = winning_seqs(delta, rule, seq)
    # A row that won several columns is fetched once; arrivals are unique, so no task gets a hot key here.
    seqs = F.array_distinct(F.array_compact(F.array("first_seq", *[F.col("newest")[c] for c in changing])))
    asked = won.select(F.col(rule.key).alias("_key"), "first_seq", "newest", F.explode(seqs).alias("_seq"))
    rows = delta.select(F.col(seq).alias("_seq"), F.struct(*columns).alias("row"))
    fetched = asked.join(rows, "_seq")
    # At most one row per changing column and one more come together again.
    held = fetched.groupBy("_key").agg(
        F.any_value("first_seq").alias("first_seq"), F.collect_list(F.struct("_seq", "row", "newest")).alias("held"))
    values = held.select(
        F.col("_key").alias(rule.key), "first_seq", F.map_from_entries(F.transform("held", lambda h: F.struct(h["_seq"], h["row"]))).alias("rows"),
        F.col("held")[0]["newest"].alias("won"))

    def value(at: Column, c: str) -> Column:
        return F.try_element_at("rows", at)[c]

    return values.select(
        rule.key, "first_seq", F.try_element_at("rows", F.col("first_seq")).alias("first"),
        F.struct(*[value(F.col("won")[c], c).alias(c) for c in changing]).alias("newest"))


def inserted_rows(folded: DataFrame, rule: MergeRule) -> DataFrame:
    """Rows of keys that are new: first values, overridden by what came later in the batch."""
    columns = folded.schema["first"].dataType.fieldNames()
    changing = folded.schema["newest"].dataType.fieldNames()

    def value(c: str) -> Column:
        options = [F.col("newest")[c]] if c in changing else []
        options.append(F.col("first")[c])
        if c in rule.defaults:
            options.append(F.lit(rule.defaults[c]))
        return F.coalesce(*options).alias(c)

    return folded.select(F.col("first_seq").alias("seq"), rule.key, *[value(c) for c in columns])


def updated_rows(snapshot: DataFrame, folded: DataFrame, rule: MergeRule) -> DataFrame:
    """The snapshot with the newest values of its keys. Only changing columns are joined in."""
    changing = folded.schema["newest"].dataType.fieldNames()
    joined = snapshot.join(folded.select(rule.key, "newest"), rule.key, "left")
    changed = {c: F.coalesce(F.col("newest")[c], F.col(c)) for c in changing}
    return joined.withColumns(changed).select(snapshot.columns)


def new_keys(snapshot: DataFrame, folded: DataFrame, rule: MergeRule) -> DataFrame:
    """The folded rows whose key the snapshot lacks.

    The snapshot is first cut down to the keys that occur in the batch. With a small batch that is
    a map-side pass over one column instead of a shuffle of every stored key.
    """
    stored = snapshot.select(rule.key).join(folded.select(rule.key), rule.key, "left_semi")
    return folded.join(stored, rule.key, "left_anti")


def merge(snapshot: DataFrame, delta: DataFrame, rule: MergeRule, seq: str = "seq") -> DataFrame:
    """The snapshot after the batch, new rows without an id yet (`id` null, `seq` = arrival)."""
    folded = fold_delta(delta, rule, seq)
    old = updated_rows(snapshot, folded, rule).withColumn("seq", F.lit(None).cast("bigint"))
    new = inserted_rows(new_keys(snapshot, folded, rule), rule)
    return old.unionByName(new, allowMissingColumns=True)


def upsert_papers(snapshot: DataFrame, delta: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(snapshot, delta, PAPERS, seq)


def upsert_jobs(snapshot: DataFrame, delta: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(snapshot, delta, JOBS, seq)


def upsert_news(snapshot: DataFrame, delta: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(snapshot, delta, NEWS, seq)


def assign_ids(rows: DataFrame, start: int = 0, seq: str = "seq", ranges: int | None = None) -> DataFrame:
    """Dense ids start+1, start+2, … in `seq` order (unique per row), as a leading `id` column.

    The order is cut into ranges at quantiles, fixed as literals; rows are numbered inside their
    range and shifted by the sizes of the ranges before. Only `ranges` numbers reach the driver and
    no window spans the whole table. `rows` is read three times: stage it if it is expensive.
    """
    spark = rows.sparkSession
    count = ranges or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 512)
    marks = [i / count for i in range(1, count)]
    bounds = []
    if marks:
        bounds = rows.agg(F.percentile_approx(seq, marks, 20 * count).alias("b")).first()["b"] or []
    cuts = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<bigint>")
    ranged = rows.withColumn("_range", F.size(F.filter(cuts, lambda b: b < F.col(seq))))
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    before, shifts = start, []
    for number in range(len(set(bounds)) + 1):
        shifts.append(before)
        before += sizes.get(number, 0)
    shift = F.element_at(F.array(*[F.lit(s) for s in shifts]).cast("array<bigint>"), F.col("_range") + 1)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(seq))
    return ranged.select((shift + place).alias("id"), *[c for c in rows.columns if c != "id"])
