"""Line dedup by a segment-partition edit join.

Two lines are copies when at most `distance` edits apart. A line is cut into `distance` + 1 segments; of two
lines within the distance at least one segment of the shorter one stands unchanged in the longer one, near
its own place. So every line enters its segments into an index by (length, segment number, text), and looks
up, for every length it may pair with, the substrings of itself that can be that segment: those whose
shift leaves enough edits for both sides. Lines that meet in the index are verified with bit-parallel edit
distance inside a band of 2 * distance + 1 diagonals, many pairs at once.

Lines that share a segment are mostly no copies. Every key carries a sketch of its whole line, parities of
characters and of neighbouring characters, of which an edit turns a few only; the join under a key lets a
pair through only when its sketches leave room for the distance. Keys and sketches are made in one pass
over the text. Only lines that pass are fetched and verified: a filter of at most `FILTER_WORDS` broadcast words
keeps nearly all others out of the shuffle as long as fewer lines are asked for than it has bits; beyond that
it lets more of them through, and nothing is lost.

Equal lines are folded first, with map-side combining, so a line that a third of the corpus repeats is one
row and stands for its class. Every pair of classes that may be within the distance is verified, so that
the links of a line can be counted: n different lines that are all copies of each other have n * n / 2 links.

Defined results
---------------
* Lines are split at line feeds. Lines without a word are never dropped and never counted as copies. Lines
  shorter than `min_chars` are copies only when equal (two edits make many words of one another); longer ones
  when within `distance` edits.
* Of each group of linked lines the first stays: the smallest (document id, line number). Null ids come last.
* Null and empty texts have no lines. Lines of any length are compared whole, by code points.
* Rows that repeat an id are told apart by their text; rows that repeat id and text are the same document,
  and so keep the same lines. Null ids are told apart by their text as well. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.components import components
from gleanwork.session import staged

DISTANCE = 2
MIN_CHARS = 20
# Pairs verified together: bounds the memory of the arrays below.
BLOCK_CELLS = 1 << 22
# Characters signed together.
BLOCK_CHARS = 1 << 20
# Words of 64 bits in the filter of the lines to fetch, two bits a line.
FILTER_WORDS = 1 << 18
WORD = r"[^\x20\x09-\x0D]"
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it can be divided by
_SPREAD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def shifts(k: int, count: int, longer: int) -> list[int]:
    """Where segment k (from 0) of the shorter line may stand in a line longer by `longer`, as shifts.

    The k segments before it have taken at most k edits when it is the first to match, the
    ones behind it have the other edits; both sides must absorb the shift.
    """
    edits = count - 1
    left = range(-k, k + 1)
    right = range(longer - (edits - k), longer + (edits - k) + 1)
    return [s for s in left if s in right]


def probes(distance: int) -> list[tuple[int, int, int]]:
    """(segment, by how much the other line is shorter, shift) of every key of a line; index keys come first."""
    count = distance + 1
    looked = [(k, longer, s) for k in range(count) for longer in range(count) for s in shifts(k, count, longer)]
    own = [(k, 0, 0) for k in range(count)]
    return own + [x for x in looked if x not in own]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    x = (x ^ (x >> np.uint64(31))) * _SPREAD[0]
    x = (x ^ (x >> np.uint64(29))) * _SPREAD[1]
    return x ^ (x >> np.uint64(32))


def sign(lines: list[str], distance: int, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(sketches, keys) of lines: one long each, and one row of `probes` keys each, 0 where there is none.

    Hashes of all substrings come from one running sum over the code points of all lines. A sketch
    holds, in its upper and lower 32 bits, the parities of characters and of neighbouring characters dealt
    to 32 places: one edit turns at most 2 of the former and 4 of the latter.
    """
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(length)
    first = ends - length
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
    symbols = _mixed(codes + np.uint64(1))
    n = len(codes)
    with np.errstate(over="ignore"):
        power = np.full(n + 1, _BASE, np.uint64)
        back = np.full(n + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        power[0] = back[0] = 1
        power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * power[:-1], out=sums[1:])

        # Parities of a stretch are those of the running exclusive or at its ends.
        one = np.uint64(1)
        single = np.zeros(n + 1, np.uint64)
        np.bitwise_xor.accumulate(one << (symbols & np.uint64(31)), out=single[1:])
        double = np.zeros(n + 1, np.uint64)
        if n > 1:
            both = _mixed(symbols[:-1] + symbols[1:] * _BASE) & np.uint64(31)
            np.bitwise_xor.accumulate(one << both, out=double[2:])
        inner = np.minimum(first + 1, ends)  # a pair of characters counts at its second one
        sketch = (single[ends] ^ single[first]) << np.uint64(32) | (double[ends] ^ double[inner])

        count = distance + 1
        found = probes(distance)
        keys = np.zeros((len(lines), len(found)), np.uint64)
        for column, (k, longer, shift) in enumerate(found):
            shorter = length - longer
            size, more = shorter // count, shorter % count
            begin = size * k + np.maximum(more - (count - k), 0) + shift
            own = size + (more >= count - k)
            fits = (shorter >= max(count, min_chars)) & (begin >= 0) & (begin + own <= length)
            start = np.where(fits, first + begin, 0)
            end = np.where(fits, start + own, 0)
            text = (sums[end] - sums[start]) * back[start]
            place = _mixed((shorter * count + k).astype(np.uint64))
            keys[:, column] = np.where(fits, np.maximum(_mixed(text ^ place), one), np.uint64(0))
    return sketch.view(np.int64), keys.view(np.int64)


def _sign(distance: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("line")
            lines = batch.column(at).to_pylist()
            kept = [i for i in range(batch.num_columns) if i != at]
            start = size = 0
            for i, line in enumerate(lines):
                size += len(line)
                if size < BLOCK_CHARS and i + 1 < len(lines):
                    continue
                sketch, keys = sign(lines[start : i + 1], distance, min_chars)
                ends = np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]
                part = batch.slice(start, i + 1 - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(sketch), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    [batch.schema.field(c).name for c in kept] + ["sketch", "keys"])
                start, size = i + 1, 0

    return run


def may_link(a: str, b: str, distance: int) -> Column:
    """Whether two sketches leave room for a pair within the distance; never false for such a pair."""
    return F.expr(f"bit_count(shiftrightunsigned({a} ^ {b}, 32)) <= {2 * distance} and bit_count(({a} ^ {b}) & 4294967295L) <= {4 * distance}")


def within(a: list[np.ndarray], b: list[np.ndarray], distance: int) -> np.ndarray:
    """Whether the edit distance of each pair of code point arrays is at most `distance`.

    One machine word per pair holds the band: bit k of step i stands for character i - distance + k of `a`
    against character i of `b`, and says whether the value below is one more (`up`) or one less (`down`). Each
    step moves all pairs on by one character with a dozen word operations, one addition carrying matches along
    the column. The distance is followed down the band's lowest diagonal, then along the last row.
    """
    width = 2 * distance + 2
    if width > 64:
        raise ValueError("the band does not fit a machine word")
    n = len(a)
    # A common prefix changes no distance and keeps the band's start inside both texts.
    pad = distance + 1
    len_a, len_b = (np.array([len(x) for x in texts], np.int64) + pad for texts in (a, b))
    near = np.abs(len_a - len_b) <= distance
    steps = int(len_b.max()) if n else 0
    wide = np.full((n, max(steps, int(len_a.max()) if n else 0) + 2 * width), -1, np.int32)
    tall = np.full((n, steps), -2, np.int32)
    wide[:, distance : distance + pad], tall[:, :pad] = -3, -3
    for i in range(n):
        wide[i, distance + pad : distance + len_a[i]] = a[i]
        tall[i, pad : len_b[i]] = b[i]
    one = np.uint64(1)
    full = np.uint64(2**width - 1)
    lowest = np.uint64(2 * distance)  # the bit of the band's lowest diagonal
    up = np.full(n, (2**width - 1) ^ (2**distance - 1), np.uint64)
    down = np.zeros(n, np.uint64)
    value = np.full(n, distance, np.int64)
    turn = len_a - distance  # from this step on the last row is followed
    for i in range(steps):
        same = np.zeros(n, np.uint64)
        for k in range(width):
            same |= (wide[:, i + k] == tall[:, i]).astype(np.uint64) << np.uint64(k)
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right = (down | ~(diagonal | up)) & full
        left = diagonal & up
        running = i < len_b
        down_band = running & (i < turn)
        value += down_band & ((diagonal >> lowest) & one == 0)
        along = running & (i >= turn)
        if along.any():
            bit = np.clip(2 * distance - 1 - (i - turn), 0, 63).astype(np.uint64)
            value += np.where(along, ((right >> bit) & one).astype(np.int64) - ((left >> bit) & one).astype(np.int64), 0)
        shifted = diagonal >> one
        up = (left | ~(shifted | right)) & full
        down = shifted & right
    return near & (value <= distance)


def _verify(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("x", "y"))
            sizes = np.array([len(t) for t in y], np.int64)
            order = np.argsort(sizes, kind="stable")
            good = np.zeros(batch.num_rows, bool)
            at = 0
            while at < len(order):
                # Pairs of about one length go together; a very long pair goes alone.
                end = at + 1
                while end < len(order) and (end + 1 - at) * (sizes[order[end]] + 8) <= BLOCK_CELLS:
                    end += 1
                part = order[at:end]
                codes = [[np.frombuffer(t[i].encode("utf-32-le"), np.int32) for i in part] for t in (x, y)]
                good[part] = within(*codes, distance)
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).filter(pa.array(good)) for c in ("a", "b")], ["a", "b"])

    return run


def _prints(line: str = "line") -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), F.reverse(line)).alias("h2")]


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, print, line_no, line) of every line with a word."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("print"), F.col(f"`{text}`").alias("text"))
    cut = rows.select("id", "print", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return cut.where(F.col("line").rlike(WORD))


def _distinct(lines: DataFrame, distance: int, min_chars: int) -> DataFrame:
    """(h1, h2, n, place, sketch, keys, item) of every distinct line; texts stay where they are."""
    signed = lines.select("id", "print", "line_no", *_prints(), "line")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in signed.schema if f.name != "line")
    signed = signed.mapInArrow(_sign(distance, min_chars), f"{fields}, sketch bigint, keys array<bigint>")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "print", "line_no")
    # Equal lines fold before the shuffle.
    folded = signed.select("h1", "h2", place.alias("place"), "sketch", "keys").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("place").alias("place"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    return folded.withColumn("item", F.monotonically_increasing_id())


def _maybe_asked(lines: DataFrame, asked: DataFrame) -> DataFrame:
    """Of `lines` those whose h1, h2 are among `asked`, and few others."""
    word = F.pmod("h1", F.lit(FILTER_WORDS)).alias("word")
    bits = F.expr("shiftleft(1L, CAST(h2 & 63 AS INT)) | shiftleft(1L, CAST(shiftrightunsigned(h2, 6) & 63 AS INT))")
    words = asked.groupBy(word).agg(F.bit_or(bits).alias("held"))
    return lines.withColumn("word", word).join(F.broadcast(words), "word").where((F.col("held").bitwiseAND(bits)) == bits).drop("word", "held")


def _links(lines: DataFrame, distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b), a < b, of all `distinct` lines within the distance."""
    met = distinct.select("item", "sketch", F.posexplode("keys").alias("k", "bucket")).where("bucket <> 0")
    # A pair within the distance meets under an index key of the shorter line; lookups need not meet each other.
    own = met.where(F.col("k") <= distance).select("bucket", F.col("item").alias("x"), F.col("sketch").alias("of_x"))
    other = met.select("bucket", F.col("item").alias("y"), F.col("sketch").alias("of_y"), (F.col("k") <= distance).alias("indexed"))
    pairs = own.join(other, "bucket").where("x < y or x > y and not indexed").where(may_link("of_x", "of_y", distance))
    pairs = staged(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("item")).distinct()
    asked = staged(distinct.select("item", "h1", "h2").join(asked, "item"), "asked")
    # A line that many documents repeat is folded again before its text moves.
    texts = _maybe_asked(lines.select(*_prints(), "line"), asked).join(asked, ["h1", "h2"]).groupBy("item").agg(F.first("line").alias("line"))
    texts = staged(texts, "texts")
    both = pairs.join(texts.select(F.col("item").alias("a"), F.col("line").alias("x")), "a").join(
        texts.select(F.col("item").alias("b"), F.col("line").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_verify(distance), "a bigint, b bigint")


def line_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per distinct line that has a copy: h1, h2 (its fingerprint), n (times it occurs), n_links, label (its group), first.

    Lines that occur once and have no other line within the distance are left out: they are their own
    class. `n_links` counts the other distinct lines within the distance, `first` is the struct (none, id,
    print, line_no) of the group's first line, so the line that stays.
    """
    lines = _lines(docs, key, text)
    distinct = staged(_distinct(lines, distance, min_chars), "lines")
    links = staged(_links(lines, distinct, distance), "links")
    degrees = links.select(F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.count("*").alias("n_links"))
    groups = components(links).join(degrees, "item")
    marked = distinct.select("h1", "h2", "n", "item", "place").join(groups, "item", "left").where("n > 1 or label is not null")
    marked = staged(marked.withColumns({"label": F.coalesce("label", "item"), "n_links": F.coalesce("n_links", F.lit(0))}), "marked")
    first = marked.groupBy("label").agg(F.min("place").alias("first"))
    return marked.join(first, "label").select("h1", "h2", "n", "n_links", "label", "first")


CLASS = ("first_id", "first_print", "first_line", "kept", "n_links")


def _own_class(where: Callable[[str], Column]) -> list[Column]:
    """The class of a line without copies, from its own id, print and line_no."""
    return [where("id").alias("first_id"), where("print").alias("first_print"), where("line_no").alias("first_line"),
            F.lit(True).alias("kept"), F.lit(0).cast("bigint").alias("n_links")]


def _copied_lines(lines: DataFrame, copies: DataFrame) -> DataFrame:
    """(id, print, line_no, line_chars and `CLASS`) of the lines that have copies."""
    own = F.struct(F.col("id").isNull().alias("none"), "id", "print", "line_no")
    marked = lines.select("id", "print", "line_no", F.length("line").alias("line_chars"), *_prints())
    # Unique on the right; a line that holds a large share of the rows is split by the adaptive join.
    return marked.join(copies, ["h1", "h2"]).select(
        "id", "print", "line_no", "line_chars", F.col("first.id").alias("first_id"), F.col("first.print").alias("first_print"),
        F.col("first.line_no").alias("first_line"), own.eqNullSafe(F.col("first")).alias("kept"), "n_links")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a word: `key`, print, line_no (from 0), its class, kept, n_links, line_chars.

    The class is named by its first line (first_id, first_print, first_line), so it is the same in every run.
    `n_links` as in `line_copies`.
    """
    copies = staged(line_copies(docs, key, text, distance, min_chars), "copies")
    lines = _lines(docs, key, text)
    alone = lines.select("id", "print", "line_no", F.length("line").alias("line_chars"), *_prints()).join(copies, ["h1", "h2"], "left_anti")
    alone = alone.select("id", "print", "line_no", "line_chars", *_own_class(F.col))
    return _copied_lines(lines, copies).unionByName(alone).select(F.col("id").alias(key), "print", "line_no", *CLASS, "line_chars")


def document_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE,
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of `docs`, those without lines too: `key`, n_lines, n_dropped, dropped_chars, n_links, lines.

    `lines` lists line_no, first_id, first_print, first_line, kept, n_links and line_chars in line order. Only
    lines that have copies are looked up; what a document says about its other lines never leaves its row.
    """
    copies = staged(line_copies(docs, key, text, distance, min_chars), "copies")
    line = F.struct("line_no", F.lit(False).alias("alone"), *CLASS, "line_chars")
    # A set, so rows that repeat id and text count once; it is no longer than the document.
    found = _copied_lines(_lines(docs, key, text), copies).groupBy("id", "print").agg(F.collect_set(line).alias("copied"))
    found = found.withColumnsRenamed({"id": "_id", "print": "_print"})
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("print"), F.transform(
        F.split(f"`{text}`", "\n"), lambda x, i: F.struct(i.alias("line_no"), F.length(x).alias("chars"), x.rlike(WORD).alias("word"))).alias("own"))
    rows = rows.withColumn("own", F.filter("own", lambda x: x["word"]))
    met = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left")
    own = F.transform("own", lambda x: F.struct(
        x["line_no"].alias("line_no"), F.lit(True).alias("alone"),
        *_own_class(lambda c: x["line_no"] if c == "line_no" else F.col(c)), x["chars"].alias("line_chars")))
    # Of the two entries of a line the one with copies sorts first.
    every = F.array_sort(F.concat(F.coalesce(own, F.array()), F.coalesce("copied", F.array())))
    met = met.select("id", every.alias("every")).select("id", F.filter(
        "every", lambda x, i: (i == 0) | (x["line_no"] != F.get("every", i - 1)["line_no"])).alias("lines"))
    zero = F.lit(0).cast("bigint")
    gone = F.filter("lines", lambda x: ~x["kept"])
    shown = F.transform("lines", lambda x: F.struct(*[x[c].alias(c) for c in ("line_no", *CLASS, "line_chars")]))
    return met.select(
        F.col("id").alias(key), F.size("lines").cast("bigint").alias("n_lines"), F.size(gone).cast("bigint").alias("n_dropped"),
        F.aggregate(gone, zero, lambda n, x: n + x["line_chars"]).alias("dropped_chars"),
        F.aggregate("lines", zero, lambda n, x: n + x["n_links"]).alias("n_links"), shown.alias("lines"))
