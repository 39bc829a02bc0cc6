"""Incremental forms: bounded URL dedup, freshness filter, keyed upsert."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from gleanwork.functions.dates import is_fresh
from gleanwork.operators.dedup import with_normalized_url
from gleanwork.operators.upsert import MergeRule
from gleanwork.sources.store import TableStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_dedup_urls(pages: DataFrame, delay: str = "1 day", event_time: str = "fetched_at") -> DataFrame:
    """First arrival per canonical URL, remembered for `delay` of event time.

    State is bounded by the watermark; which of several copies in one micro-batch survives is open.
    Use `dedup_into` where the lowest `seq` must win or the memory must not end.
    """
    return with_normalized_url(pages).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
        ["normalized_url"]
    )


def stream_fresh_only(
    records: DataFrame, published: str = "published_date", event_time: str = "fetched_at", hours: int = 24
) -> DataFrame:
    """Records whose date lies within `hours` before their own event time, so a replay agrees."""
    return records.where(is_fresh(F.col(published), F.col(event_time), hours))


def stream_upsert(
    delta: DataFrame,
    store: TableStore,
    table: str,
    rule: MergeRule,
    checkpoint: str,
    batch_ts: Callable[[int], datetime],
    seq: str = "seq",
    **trigger,
) -> StreamingQuery:
    """Merge every micro-batch into a stored table; a replayed batch is recognised and skipped.

    Rows without a key are found in `store.read_rejected`.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.upsert(table, batch, rule, batch_ts(batch_id), seq=seq, batch=f"{checkpoint}#{batch_id}")

    return (
        delta.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class _FirstArrival(StatefulProcessor):
    """Lets the lowest `seq` of a URL's first micro-batch through and remembers the URL."""

    def __init__(self, seq: str, ttl_ms: int) -> None:
        self.seq, self.ttl_ms = seq, ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "first_seq bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        known, first = self.seen.exists(), None
        for frame in rows:  # in pieces: a hot URL is never held whole
            if not known and len(frame):
                low = frame.loc[[frame[self.seq].idxmin()]]
                if first is None or low[self.seq].iloc[0] < first[self.seq].iloc[0]:
                    first = low.copy()
        if first is not None:
            self.seen.update((int(first[self.seq].iloc[0]),))
            yield first.reset_index(drop=True)

    def close(self) -> None:
        pass


def stream_first_arrivals(pages: DataFrame, seq: str = "seq") -> DataFrame:
    """Per canonical URL the first arrival ever: the lowest `seq` of the first micro-batch that holds it. For update mode.

    URLs seen are keyed state in the RocksDB store, on disk beside the checkpoint: no micro-batch reads the history
    again, and a restart goes on where the last one ended. The state is an aggregation with the first and the last
    micro-batch of a URL, told by their batch times: where both are one, the URL is new. Rows of a URL are combined before
    the shuffle. State holds a row per URL, so select what you need before. Rows without a URL all pass.
    """
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # The canonical form is null where the URL is, so only one of the two makes it.
    keyed, free = (with_normalized_url(pages.where(url)) for url in (F.col("url").isNotNull(), F.col("url").isNull()))
    row, rank = F.struct(*(F.col(f"`{c}`") for c in keyed.columns if c != "normalized_url")), F.struct(F.col(seq).isNull(), F.col(seq))
    timed = keyed.select("normalized_url", row.alias("row"), rank.alias("rank"), F.current_timestamp().alias("at"))
    seen = timed.groupBy("normalized_url").agg(F.min_by("row", "rank").alias("row"), F.min("at").alias("since"), F.max("at").alias("until"))
    columns = (F.col(c) if c == "normalized_url" else F.col("row").getField(c).alias(c) for c in keyed.columns)
    return seen.where(F.col("since") == F.col("until")).select(*columns).unionAll(free)


def stream_first_arrivals_within(pages: DataFrame, ttl: timedelta, seq: str = "seq") -> DataFrame:
    """The same for append mode, where a URL counts as new again a `ttl` after its first arrival (processing time).

    Rows pass through Python, and every URL of a micro-batch costs calls to the state store: for small batches.
    """
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    named = with_normalized_url(pages)
    keyed, free = named.where(F.col("normalized_url").isNotNull()), named.where(F.col("normalized_url").isNull())
    processor = _FirstArrival(seq, int(ttl.total_seconds() * 1000))
    firsts = keyed.groupBy("normalized_url").transformWithStateInPandas(processor, keyed.schema, "Append", "ProcessingTime")
    return firsts.unionAll(free)


def dedup_into(pages: DataFrame, out_path: str, checkpoint: str, seq: str = "seq", ttl: timedelta | None = None, **trigger) -> StreamingQuery:
    """`stream_first_arrivals` into a Parquet folder, a partition `micro_batch` for each; a replayed one replaces its own.

    Without a `trigger` it takes all there is and ends; with a `ttl` in one micro-batch, since a stream that watches the
    clock never runs dry.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/micro_batch={batch_id}")

    firsts = stream_first_arrivals_within(pages, ttl, seq) if ttl else stream_first_arrivals(pages, seq)
    return (
        firsts.writeStream.outputMode("append" if ttl else "update").foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ({"once": True} if ttl else {"availableNow": True})))
        .start()
    )


def stream_freshness_summary(
    records: DataFrame, kind: str, published: str = "published_date", event_time: str = "fetched_at",
    window: str = "1 day", delay: str = "1 hour", hours: int = 24,
) -> DataFrame:
    """(window_start, `kind`, n_rows, n_fresh) of closed event-time windows, for append mode.

    A window is given out once, when the watermark has passed its end; rows that come later are not counted in it
    (the query's progress reports them as dropped by the watermark). State holds open windows only.
    """
    fresh = is_fresh(F.col(published), F.col(event_time), hours)
    timed = records.select(F.col(event_time).alias("at"), kind, fresh.alias("fresh")).withWatermark("at", delay)
    counts = timed.groupBy(F.window("at", window).alias("w"), kind).agg(F.count("*").alias("n_rows"), F.count_if("fresh").alias("n_fresh"))
    return counts.select(F.col("w.start").alias("window_start"), kind, "n_rows", "n_fresh")


def dropped_late(query: StreamingQuery) -> int:
    """Rows of a finished query that came behind its watermark, as far as its recent progress tells.

    Partial aggregation comes before the check, so rows of one window and kind count as one.
    """
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
