"""Left lookup joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1/HOT_SHARE of all rows, so there are at most HOT_SHARE of
# them: that bound is what makes the broadcasts below safe at any scale.
HOT_SHARE = 1000


def hot_keys(rows: DataFrame, key: str) -> list:
    """The at most HOT_SHARE keys that hold 1/HOT_SHARE of the rows or more.

    Runs one aggregation over the key column; only the hot keys reach the driver.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("n_total"))
    heavy = counts.where(F.col(key).isNotNull() & (F.col("n_rows") * HOT_SHARE >= total.scalar()))
    return [row[0] for row in heavy.select(key).collect()]


def lookup_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` left-joined with `table`, which has at most one row per key.

    Rows with a hot key are answered from a broadcast of at most HOT_SHARE rows, and rows without a
    key need no answer, so neither is shuffled; the rest meets `table` in a join without heavy keys.
    `rows` is read for the counts and again for the join: stage it first if it is expensive.
    """
    values = [c for c in table.columns if c != key]
    hot = hot_keys(rows, key)
    order = [*rows.columns, *values]
    column = F.col(key)
    cold = rows.where(column.isNotNull() & ~column.isin(hot)).join(table, key, "left")
    if hot:
        answers = F.broadcast(table.where(column.isin(hot)))
        direct = rows.where(column.isNull() | column.isin(hot)).join(answers, key, "left")
    else:
        blank = [F.lit(None).cast(table.schema[v].dataType).alias(v) for v in values]
        direct = rows.where(column.isNull()).select(*rows.columns, *blank)
    return cold.select(order).unionAll(direct.select(order))
