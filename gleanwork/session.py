"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: dates are formatted in the session zone, hot keys are
# split at run time on top of what the operators do themselves, and Python workers get texts in
# small batches, so that their memory does not depend on how many rows a task has.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

_scratch: list[str] = []


def build_session(master: str | None = None, app: str = "gleanwork", **conf: str) -> SparkSession:
    """A session with the settings above. On a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session someone else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """`key` is `value` for what runs inside, and afterwards what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate tables.

    `spark.checkpoint.dir` names it, or a `setCheckpointDir` call. Only a local master may do
    without: executors of a cluster would each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        shared = held.get() if held.isDefined() else None
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables under the shared folder; `clear_scratch` removes it."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables made so far. Results not yet written must not need them."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(hadoop).delete(path, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back.

    For results that are expensive and read more than once: later passes do not repeat their
    making, and a lost executor takes nothing with it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
