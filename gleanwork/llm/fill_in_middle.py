"""Fill-in-middle: documents cut into prefix, middle and suffix at unit borders found by word-wide arithmetic.

A unit is a run of ASCII letters or any other single code point. Texts are looked at as UTF-8, eight bytes to
one unsigned 64-bit word. A few additions and masks mark, in all eight bytes at once, the bytes that end a unit;
`bitwise_count` counts the marks per word, their running sum says in which word the k-th unit of a text ends
(binary search), and a multiplication finds the byte inside that word. No unit is visited on its own, and the
same sums over the first bytes of code points give lengths in characters.

The draws of a document come from a SHA-256 of its id, so every run and every partitioning agrees.

Defined results
---------------
* A null or empty text has no units and stays plain, as does a text that holds one of the three markers.
* A null id is drawn for as the empty id. Rows that repeat an id are cut by the same draws, each in its text.
* Texts of any length are cut whole, about BLOCK_BYTES of text at a time. Empty tables give empty results.
* Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers, the seed before the id, and the per cent of each form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
FORMED, SUFFIX_FIRST = 90, 20
# Texts are cut in blocks of about so many bytes: a longer text is a block of its own.
BLOCK_BYTES = 8 << 20

_TOP = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)


def _each(byte: int) -> np.uint64:
    return np.uint64(byte) * _ONES


def _following(marks: np.ndarray) -> np.ndarray:
    """The marks of each byte's successor, at that byte's place."""
    return (marks >> np.uint64(8)) | np.concatenate([marks[1:] << np.uint64(56), np.zeros(1, np.uint64)])


def unit_marks(words: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit ends, code point starts) of UTF-8 text as words: the top bit of each byte that is one.

    `lasts` are the places of bytes that end a text, so that texts may lie side by side.
    """
    folded = (words | _each(0x20)) & ~_TOP
    letters = (folded + _each(0x80 - ord("a"))) & ~(folded + _each(0x7F - ord("z"))) & ~words & _TOP
    inner = words & ~(words << np.uint64(1)) & _TOP  # 10xxxxxx: a code point goes on
    ends = ~((letters & _following(letters)) | _following(inner)) & _TOP
    np.bitwise_or.at(ends, lasts >> 3, np.uint64(0x80) << ((lasts & 7) << 3).astype(np.uint64))
    return ends, ~inner & _TOP


class Marks:
    """Counting and finding marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marked bytes lie before each place."""
        word, inside = at >> 3, ((at & 7) << 3).astype(np.uint64)
        padded = np.concatenate([self.marks, np.zeros(1, np.uint64)])[word]
        return self.before[word] + np.bitwise_count(padded & ((np.uint64(1) << inside) - np.uint64(1)))

    def place(self, k: np.ndarray) -> np.ndarray:
        """Where the mark numbered k (from 1) lies."""
        word = np.searchsorted(self.before, k, "left") - 1
        rest = (k - self.before[word]).astype(np.uint64)
        # Byte i of the product counts the marks in bytes 0 to i; those short of `rest` lie before it.
        counted = (self.marks[word] >> np.uint64(7)) * _ONES
        reached = ((counted | _TOP) - rest * _ONES) & _TOP
        return word * 8 + 8 - np.bitwise_count(reached).astype(np.int64)


def cut(texts: list[bytes], first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """Per text: units, bytes and characters before the first cut, bytes and characters before the second.

    `first` and `second` are draws; they count modulo the number of units plus one.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(sizes)
    start = stop - sizes
    data = np.frombuffer(b"".join(texts) + bytes(8 + -int(stop[-1]) % 8), np.uint8).view(np.dtype("<u8"))
    ends, heads = unit_marks(data, stop[sizes > 0] - 1)
    units, points = Marks(ends), Marks(heads)
    before = units.rank(start)
    n = units.rank(stop) - before
    out = [n]
    one, two = first % (n + 1), second % (n + 1)
    for k in (np.minimum(one, two), np.maximum(one, two)):
        at = np.where(k > 0, units.place(np.maximum(before + k, 1)) + 1, start)
        out += [at - start, points.rank(at) - points.rank(start)]
    return out


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size, begin = 0, 0
    lengths = pc.binary_length(batch.column("text").cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
    for i, length in enumerate(lengths.tolist()):
        if size and size + length > BLOCK_BYTES:
            yield batch.slice(begin, i - begin)
            size, begin = 0, i
        size += length
    if batch.num_rows:
        yield batch.slice(begin)


def _transform(formed: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                h1, h2, h3, h4 = (part.column(h).to_numpy(zero_copy_only=False) for h in ("h1", "h2", "h3", "h4"))
                n, a, a_chars, b, b_chars = cut(texts, h1, h2)
                forms, outputs = [], []
                for text, x, y, drawn, order in zip(texts, a.tolist(), b.tolist(), (h3 % 100).tolist(), (h4 % 100).tolist()):
                    if not text or drawn >= formed or any(m in text for m in marks):
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    first, last = marks[0] + text[:x], marks[1] + text[y:]
                    forms.append("spm" if order < suffix_first else "psm")
                    outputs.append((last + first if order < suffix_first else first + last) + marks[2] + text[x:y])
                form = pa.array(forms, pa.string())
                plain = pc.equal(form, "plain").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), form, pa.array(a_chars, mask=plain), pa.array(b_chars - a_chars, mask=plain),
                     pa.array(outputs, pa.binary()).cast(pa.string())],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, formed: int = FORMED,
                   suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: `key`, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output.

    `formed` per cent of the documents are rearranged, `suffix_first` per cent of those with the suffix in front.
    """
    ident = F.col(f"`{key}`")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(ident.alias("id"), F.col(f"`{text}`").alias("text"), *numbers)
    id_type = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(
        _transform(formed, suffix_first),
        f"id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return made.withColumnRenamed("id", key)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. A rearranged text holds no marker, so the markers part it exactly."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    psm, spm = F.concat(first, middle, second), F.concat(second, middle, first)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
