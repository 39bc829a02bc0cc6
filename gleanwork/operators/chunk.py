"""Cutting cleaned text into overlapping chunks at natural breaks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.records import build_prompt
from gleanwork.operators.html import visible_text

# Sizes by default, and the breaks a chunk may end on.
MAX_CHARS = 4000
OVERLAP = 200
BREAKS = ("\n\n", ". ", "\n")
_FLUSH_CHARS = 4_000_000


def chunk_spans(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of each chunk. A break counts if it lies past the middle of the window."""
    start = 0
    while len(text) - start > size:
        stop = start + size
        at = max(text.rfind(mark, start, stop) for mark in BREAKS)
        if at > start + size // 2:
            stop = at + 1
        yield start, stop
        start = max(start + 1, stop - overlap)
    if start < len(text):
        yield start, len(text)


def text_chunks(raw: str | None, size: int = MAX_CHARS, overlap: int = OVERLAP) -> Iterator[str]:
    """Trimmed non-empty chunks of the cleaned text."""
    text = visible_text(raw)
    for start, stop in chunk_spans(text, size, overlap):
        piece = text[start:stop].strip()
        if piece:
            yield piece


def chunk_documents(
    docs: DataFrame,
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Rows (id, chunk_no from 0, chunk). Documents without text give no rows.

    Cleaning and cutting happen in one hop to Python; output is flushed in bounded batches, so one
    huge document does not have to fit in an Arrow batch with all its chunks.
    """
    picked = docs.select(F.col(id_col), F.col(text))
    id_field = picked.schema[id_col]
    schema = T.StructType(
        [id_field, T.StructField("chunk_no", T.IntegerType()), T.StructField("chunk", T.StringType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut_batch(batch, max_chars, overlap)

    return picked.mapInArrow(cut, schema)


def _cut_batch(batch: pa.RecordBatch, max_chars: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """The chunks of a batch (id, text), in batches of bounded size."""
    names, kind = [batch.schema.names[0], "chunk_no", "chunk"], batch.schema.types[0]
    ids, numbers, pieces, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        made = [pa.array(ids, kind), pa.array(numbers, pa.int32()), pa.array(pieces, pa.string())]
        return pa.RecordBatch.from_arrays(made, names=names)

    for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for number, piece in enumerate(text_chunks(raw, max_chars, overlap)):
            ids.append(key)
            numbers.append(number)
            pieces.append(piece)
            held += len(piece)
            if held > _FLUSH_CHARS:
                yield flush()
                ids, numbers, pieces, held = [], [], [], 0
    if ids:
        yield flush()


def extraction_requests(
    docs: DataFrame, system: str | None = None, max_chars: int = MAX_CHARS, overlap: int = OVERLAP, **columns: str
) -> DataFrame:
    """One model request per chunk: system text with the fixed JSON-only instruction, and the chunk."""
    chunks = chunk_documents(docs, max_chars, overlap, **columns)
    return chunks.withColumn("system_prompt", build_prompt(F.lit(system).cast("string")))


def register_chunk_udtf(spark: SparkSession, name: str = "chunk_text") -> None:
    """`SELECT * FROM chunk_text(text, max_chars, overlap)` in SQL."""

    class ChunkText:
        def eval(self, text: str, max_chars: int, overlap: int):
            yield from enumerate(text_chunks(text, max_chars, overlap))

    spark.udtf.register(name, F.udtf(ChunkText, returnType="chunk_no: int, chunk: string"))


def register_chunk_table(spark: SparkSession, name: str = "chunk_table", id_type: str = "bigint") -> None:
    """`SELECT * FROM chunk_table(TABLE(docs), max_chars, overlap)`: chunks of a table (id, text), batch by batch."""

    class ChunkTable:
        def eval(self, rows: pa.RecordBatch, max_chars: pa.Array, overlap: pa.Array) -> Iterator[pa.Table]:
            if rows.num_rows:
                for made in _cut_batch(rows, max_chars[0].as_py(), overlap[0].as_py()):
                    yield pa.Table.from_batches([made.rename_columns(["id", "chunk_no", "chunk"])])

    spark.udtf.register(name, F.arrow_udtf(ChunkTable, returnType=f"id {id_type}, chunk_no int, chunk string"))
