"""Token ids as Parquet files for training readers.

Layout: one row per document in ascending id order, dealt to files by id range, with columns `doc_id`,
`n_tokens` and `tokens` (list of int). Files have Parquet pages of the second version: sizes and ids are
delta-packed where a dictionary does not pay, token lists are dictionary-encoded (a vocabulary is small
beside a row group) and fall back to delta packing when the dictionary grows too large. Row groups and
pages are of fixed size, so a reader takes single row groups, and the page index lets a filter on `doc_id`
skip pages. Metadata is read without touching the tokens.

Texts are sorted before they are encoded: the sort moves text, not ids, and each text is encoded once.

Defined results
---------------
* A null text is empty; every document ends with the end id. An id may be null: such documents come first.
* Rows that repeat an id stay, side by side, ordered by a hash of their text.
* Ids are the library's own for the whole text: a special token written in a text is that token. Texts of any
  length are encoded whole.
* An empty table gives files without rows. Further columns are not written, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.llm.units import per_process

END_ID = 0
TEXT_PER_FILE = 128 << 20  # bytes
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# Texts encoded together: bounds the memory of a batch.
BLOCK_CHARS = 1 << 19

_ODD = re.compile(r" (?:\s|\Z)")
MEMO_WORDS = 800_000
# New words encoded side by side in one call.
TOGETHER = 500
# Fixed value: how the vocabulary spells a blank.
BLANK = "\u0120"
# Latin letters, which are letters to every version of Unicode.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_WORD = re.compile(f" ?[{LETTERS}]+")


def pieces(text: str) -> list[str]:
    """Cut a text where the byte-level tokenizer's word pattern cuts whatever stands around.

    A blank before a non-space always begins a word of its own, so each piece but the first keeps its
    blank. Blanks before other white space stay inside the piece before.
    """
    parts = text.split(" ")
    out = [parts[0]]
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return out


def _fast_pieces(text: str) -> list[str]:
    """`pieces` for the common case, without a Python step per word."""
    if "\0" in text or _ODD.search(text):
        return pieces(text)
    lines = text.split("\n")
    # A line feed between other signs than white space is a piece by itself, whatever stands around.
    if len(lines) > 1 and all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
        text = "\0\n\0".join(lines)
    return text.replace(" ", "\0 ").split("\0")


class ByteEncoder:
    """Ids of texts as the library gives them for a byte-level tokenizer file.

    Words met before are taken from a bounded memo. Of new words, those of letters alone are whole words to the library,
    so its model encodes them at once; others are encoded many at a time, side by side in one text: each begins with its
    blank, no other token does, so the ids fall apart into words again.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has one core: threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        # Words come once, so the library's own cache of words is of no use.
        self.tokenizer.model._resize_cache(0)
        self.model = self.tokenizer.model
        bytes_as_text = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): bytes_as_text.pre_tokenize_str(c)[0][0] for c in " " + LETTERS}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        size = self.tokenizer.get_vocab_size()
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]
        begins = np.zeros(size, bool)
        begins[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(BLANK)]] = True
        self.begins = begins
        self.known: dict[str, bytes] = {"": b""}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of LETTERS with or without one blank before them."""
        tokenize, id_bytes, join = self.model.tokenize, self.id_bytes, b"".join
        return [join([id_bytes[t.id] for t in tokenize(w)]) for w in "\n".join(words).translate(self.spelling).split("\n")]

    def _side_by_side(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a blank and hold no further white space."""
        found: list[bytes] = []
        for i in range(0, len(words), TOGETHER):
            part = words[i : i + TOGETHER]
            data = self._library(["".join(part)])[0]
            at = np.flatnonzero(self.begins[np.frombuffer(data, "<u4")])
            if len(at) != len(part) or at[0] != 0:
                found += self._library(part)
                continue
            bounds = [*(4 * at).tolist(), len(data)]
            found += [data[x:y] for x, y in zip(bounds, bounds[1:])]
        return found

    def _learn(self, words: set[str]) -> None:
        letters = [w for w in words if _WORD.fullmatch(w)]
        if letters:
            self.known.update(zip(letters, self._letters(letters)))
        if len(letters) < len(words):
            others = words.difference(letters)
            plain = [w for w in others if w[0] == " " and len(w.split()) == 1 and not w[1:2].isspace() and not w[-1].isspace()]
            self.known.update(zip(plain, self._side_by_side(plain)))
            rest = list(others.difference(plain))
            self.known.update(zip(rest, self._library(rest)))

    def _add(self, new: set[str]) -> None:
        known, cut = self.known, {w: _parts(w) for w in new if w[-1] in ".," or "\n" in w}
        whole = new.difference(cut)
        whole.update([p for p in chain.from_iterable(cut.values()) if p not in known])
        self._learn(whole)
        for w, parts in cut.items():
            if len(parts) > 1:
                known[w] = b"".join([known[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.known) >= MEMO_WORDS:
            self.known = {"": b""}
        whole = [i for i, t in enumerate(texts) if self.special and self.special.search(t)]
        split = [_fast_pieces(t) if t else [] for t in texts]
        for i in whole:  # the library parts such a text at its special tokens first
            split[i] = []
        flat = list(chain.from_iterable(split))
        ids = list(map(self.known.get, flat))
        unmet = [i for i, x in enumerate(ids) if x is None]
        if unmet:
            self._add({flat[i] for i in unmet})
            known = self.known
            for i in unmet:
                ids[i] = known[flat[i]]
        out, at = [], 0
        for pieces_ in split:
            out.append(b"".join(ids[at : at + len(pieces_)]))
            at += len(pieces_)
        for i in whole:
            out[i] = self._library([texts[i]])[0]
        return out


def _parts(piece: str) -> list[str]:
    """A piece cut once more: at a line feed between words, and before a comma or full stop after a letter."""
    if "\n" in piece:
        head, feed, tail = piece.partition("\n")
        if head and tail and not head[-1].isspace() and not tail[0].isspace():
            return [*_parts(head), feed, *_parts(tail)]
    if len(piece) > 2 and piece[-1] in ".," and piece[-2] < "ɐ" and piece[-2].isalpha():
        return [piece[:-1], piece[-1]]
    return [piece]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with about BLOCK_CHARS of text each."""
    texts = batch.column(batch.schema.get_field_index("text"))
    start = size = 0
    for i in range(batch.num_rows):
        size += texts[i].as_buffer().size if texts[i].is_valid else 0
        if size >= BLOCK_CHARS or i + 1 == batch.num_rows:
            part = batch.slice(start, i + 1 - start)
            yield part, [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
            start, size = i + 1, 0


def _encode(tokenizer_file: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("bytes", tokenizer_file), lambda: ByteEncoder(tokenizer_file))
        for batch in batches:
            for part, texts in _blocks(batch):
                # The end id goes behind each document's last id.
                lists = [x + end for x in encoder.encode(texts)]
                sizes = np.array([len(x) // 4 for x in lists], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = np.frombuffer(b"".join(lists), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["doc_id", "n_tokens", "tokens"])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, key: str = "doc_id", text: str = "text",
                      end_id: int = END_ID, text_per_file: int = TEXT_PER_FILE, row_group_bytes: int = ROW_GROUP_BYTES,
                      page_bytes: int = PAGE_BYTES) -> None:
    """Encode every text and write the files to the folder `path`, which every executor must reach.

    `tokenizer_file` is a path that exists on every executor.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Small tables are spread as far as the session spreads its shuffles, but not below 4 MB a file.
    n_files = max(1, -(-chars // text_per_file), min(wanted, -(-chars // (4 << 20))))
    dealt = rows.repartitionByRange(n_files, F.col("doc_id").asc_nulls_first())
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    encoded = dealt.mapInArrow(_encode(tokenizer_file, end_id), f"doc_id {id_type}, n_tokens bigint, tokens array<int>")
    (
        encoded.write.mode("errorifexists")
        .option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, n_tokens, tokens, file) of a folder of token files; unused columns are not read."""
    files = spark.read.schema(f"doc_id {id_type}, n_tokens bigint, tokens array<int>").parquet(path)
    return files.select("doc_id", "n_tokens", "tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def starts(files: DataFrame) -> DataFrame:
    """(file, row, doc_id, n_tokens, start): ids of all documents before each, from the metadata columns.

    File names carry the number of their range (not padded beyond 99,999, so it is read as a number). Sums per file are few
    rows; inside a file rows are summed in the order they were written.
    """
    meta = files.select("file", "row", "doc_id", "n_tokens")
    per_file = meta.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy(F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint"), "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = meta.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(offsets, "file").select("file", "row", "doc_id", "n_tokens", (F.col("offset") + F.col("inner")).alias("start"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("tokens"))
        values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
        at = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("file", "row")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(sums, pa.int64())], ["file", "row", "ids_crc32"])


def checksums(files: DataFrame) -> DataFrame:
    """(file, row, ids_crc32): unsigned CRC-32 of each document's ids as little-endian 32-bit integers."""
    return files.select("file", "row", "tokens").mapInArrow(_checksums, "file string, row bigint, ids_crc32 bigint")
