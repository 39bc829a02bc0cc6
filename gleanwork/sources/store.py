"""Stored tables: Parquet folders under versions that are published by one small file.

Layout of a table: `<root>/<table>/data/<uuid>/` holds Parquet written once and never changed,
`<root>/<table>/versions/<n>.json` names the folders that make up version n. Writing a version
file is the commit, and it fails where the version exists already, so a reader always sees a whole
table and two writers cannot publish the same version. Files go through the Hadoop file system of
the session, hence any storage Spark can reach.

A batch of an upsert writes its new rows and, apart from them, the values it changes in stored
rows; readers join these changes in. So a small batch costs one pass over the stored keys and no
rewrite. Once MAX_CHANGES batches have piled up, the next one writes the table out merged.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork import schemas
from gleanwork.operators import records, upsert

MAX_CHANGES = 16
RULES = {"research_papers": upsert.PAPERS, "jobs": upsert.JOBS, "news": upsert.NEWS}


def _batch_key(batch: str) -> tuple[str, int]:
    """`source#7` is step 7 of a source whose steps come in order; a bare name is its only step.

    The last step again is skipped as a replay; an earlier one is refused, never dropped in silence.
    """
    source, mark, step = batch.rpartition("#")
    return (source, int(step)) if mark else (batch, 0)


def _applied(manifest: dict, batch: str | None) -> bool:
    if not batch:
        return False
    source, step = _batch_key(batch)
    latest = manifest["batches"].get(source, -1)
    if step < latest:
        raise ValueError(f"batch {batch} comes after step {latest} of its source: nothing was stored")
    return step == latest


class TableStore:
    """The eight stored tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- versions ----------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _read_text(self, path: str) -> str:
        fs, target = self._fs(path)
        stream = fs.open(target)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_new(self, path: str, text: str) -> None:
        fs, target = self._fs(path)
        stream = fs.create(target, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def version(self, table: str) -> int:
        """Latest version number, 0 where the table was never created."""
        fs, folder = self._fs(f"{self.root}/{table}/versions")
        if not fs.exists(folder):
            return 0
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def manifest(self, table: str) -> dict:
        number = self.version(table)
        if not number:
            return {"version": 0, "folders": [], "changes": [], "max_id": 0, "batches": {}}
        return json.loads(self._read_text(f"{self.root}/{table}/versions/{number:010d}.json"))

    def _publish(
        self, table: str, base: dict, folders: list[str], max_id: int, batch: str | None, changes: list[str] = (),
        rejected: list[str] = (),
    ) -> None:
        number = base["version"] + 1
        batches = dict(base["batches"])
        if batch:
            source, step = _batch_key(batch)
            batches[source] = step
        body = {
            "version": number, "folders": folders, "changes": list(changes), "max_id": max_id, "batches": batches,
            "rejected": [*base.get("rejected", []), *rejected],
        }
        self._write_new(f"{self.root}/{table}/versions/{number:010d}.json", json.dumps(body))

    def _write(self, table: str, rows: DataFrame) -> str:
        """Write rows under the table's declared columns to a fresh folder."""
        folder = f"{self.root}/{table}/data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def _conform(self, table: str, rows: DataFrame) -> DataFrame:
        target = self.empty(table).schema
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])

    # -- reading -----------------------------------------------------------------------------

    def create_tables(self) -> None:
        """Publish an empty first version of every table that has none."""
        for table in schemas.TABLES:
            base = self.manifest(table)
            if not base["version"]:
                self._publish(table, base, [], 0, None)

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.TABLES[table])

    def read_table(self, table: str) -> DataFrame:
        """All rows of the current version."""
        manifest = self.manifest(table)
        rows = self._rows(table, manifest["folders"])
        if not manifest["changes"]:
            return rows
        rule = RULES[table]
        changed = [c for c in rows.columns if c in (*rule.filled, *rule.present)]
        written = self.spark.read.schema(
            rows.select(rule.key, *changed, F.lit(0).cast("bigint").alias("step")).schema
        ).parquet(*manifest["changes"])
        newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("step"))).alias(c) for c in changed]
        folded = written.groupBy(rule.key).agg(*newest).select(rule.key, F.struct(*changed).alias("newest"))
        return upsert.updated_rows(rows, folded, rule)

    def _rows(self, table: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.empty(table)
        return self.spark.read.schema(schemas.TABLES[table]).parquet(*folders)

    def read_rejected(self, table: str) -> DataFrame:
        """(batch, reasons, record) of all rows that upserts could not store; `record` is the row as JSON."""
        empty = self.spark.createDataFrame([], "batch string, reasons array<string>, record string")
        folders = self.manifest(table).get("rejected", [])
        return self.spark.read.schema(empty.schema).parquet(*folders) if folders else empty

    def lookup_by_url(self, url: str, table: str = "research_papers") -> DataFrame:
        """The row with this key, if any; the filter is pushed to the Parquet scan."""
        return self.read_table(table).where(F.col(schemas.UNIQUE_KEY[table]) == url).limit(1)

    def applied(self, table: str, batch: str | None) -> bool:
        """Whether this batch, or a later one of its source, is already part of the table."""
        return _applied(self.manifest(table), batch)

    def run_summary(self) -> DataFrame:
        """(table_name, n_rows, last_collected_at) of every table."""
        parts = []
        for table in schemas.TABLES:
            rows = self.read_table(table)
            stamp = "collected_at" if "collected_at" in rows.columns else "created_at"
            parts.append(
                rows.agg(F.count("*").alias("n_rows"), F.max(stamp).alias("last_collected_at")).select(
                    F.lit(table).alias("table_name"), "n_rows", "last_collected_at"
                )
            )
        return records.union_records(*parts)

    # -- writing -----------------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, batch_ts: datetime, seq: str = "seq", batch: str | None = None) -> None:
        """Insert rows, ids following on in `seq` order. A batch already applied is skipped."""
        base = self.manifest(table)
        if _applied(base, batch):
            return
        staged = self._stage(table, rows)
        numbered = upsert.assign_ids(staged, base["max_id"], seq)
        stamp = "collected_at" if "collected_at" in self.empty(table).columns else "created_at"
        stamped = records.stamp_collected_at(numbered, batch_ts, stamp)
        folder = self._write(table, self._conform(table, stamped))
        self._publish(table, base, [*base["folders"], folder], base["max_id"] + staged.count(), batch)
        if len(base["folders"]) >= 8 * MAX_CHANGES:
            self.compact(table)

    def append_startups(self, rows: DataFrame, batch_ts: datetime, **kw) -> None:
        self.append("startups", rows, batch_ts, **kw)

    def append_products(self, rows: DataFrame, batch_ts: datetime, **kw) -> None:
        self.append("products", rows, batch_ts, **kw)

    def append_entity_mappings(self, rows: DataFrame, batch_ts: datetime, **kw) -> None:
        self.append("entity_mappings", rows, batch_ts, **kw)

    def upsert(
        self, table: str, delta: DataFrame, rule: upsert.MergeRule, batch_ts: datetime,
        seq: str = "seq", batch: str | None = None,
    ) -> DataFrame:
        """Merge a batch into the table; returns its rows without a key, with `reasons`.

        These are kept beside the table too, see `read_rejected`. A batch already applied is skipped.
        """
        base = self.manifest(table)
        delta, lost = upsert.split_keyed(delta, rule)
        if _applied(base, batch):
            return lost
        lost = self._stage(table, lost)
        rejected = []
        if not lost.isEmpty():
            record = F.to_json(F.struct(*[c for c in lost.columns if c != "reasons"]), {"ignoreNullFields": "false"})
            rejected.append(self._write(table, lost.select(F.lit(batch).cast("string").alias("batch"), "reasons", record.alias("record"))))
        stored = self._rows(table, base["folders"])
        folded = self._stage(table, upsert.fold_delta(delta, rule, seq))
        new = self._stage(table, upsert.inserted_rows(upsert.new_keys(stored, folded, rule), rule))
        numbered = records.stamp_collected_at(upsert.assign_ids(new, base["max_id"]), batch_ts)
        known = folded.join(new.select(rule.key), rule.key, "left_anti")
        change = known.select(rule.key, "newest.*", F.lit(base["version"]).cast("bigint").alias("step"))

        folders = [*base["folders"], self._write(table, self._conform(table, numbered))]
        changes = [*base["changes"], self._write(table, change)]
        self._publish(table, base, folders, base["max_id"] + new.count(), batch, changes, rejected)
        if len(changes) > MAX_CHANGES:
            self.compact(table)
        return lost

    def compact(self, table: str) -> None:
        """Publish the same rows as one folder without pending changes."""
        base = self.manifest(table)
        folder = self._write(table, self.read_table(table))
        self._publish(table, base, [folder], base["max_id"], None)

    def upsert_papers(self, delta: DataFrame, batch_ts: datetime, **kw) -> DataFrame:
        return self.upsert("research_papers", delta, upsert.PAPERS, batch_ts, **kw)

    def upsert_jobs(self, delta: DataFrame, batch_ts: datetime, **kw) -> DataFrame:
        return self.upsert("jobs", delta, upsert.JOBS, batch_ts, **kw)

    def upsert_news(self, delta: DataFrame, batch_ts: datetime, **kw) -> DataFrame:
        return self.upsert("news", delta, upsert.NEWS, batch_ts, **kw)

    def _stage(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows written out and read back, so that passes over them do not repeat their making."""
        folder = f"{self.root}/{table}/staging/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)
