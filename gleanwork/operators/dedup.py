"""URL deduplication: the first arrival of each canonical URL wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.urls import normalize_url
from gleanwork.session import staged

# Fixed value: the error a later arrival carries.
DUPLICATE = "Duplicate URL"
# Words of 64 bits in a filter of seen URLs: at about eleven bits a URL it tells a million and a half well.
FILTER_WORDS = 1 << 18
_FETCHED = ("status_code", "content", "headers", "elapsed_seconds", "is_playwright")


def with_normalized_url(pages: DataFrame) -> DataFrame:
    return pages.withColumn("normalized_url", normalize_url(F.col("url")))


def first_arrivals(pages: DataFrame, seq: str = "seq") -> DataFrame:
    """`seq` of the first arrival per canonical URL, and of every row without a URL.

    Only (url, seq) is read and the minimum is combined before the shuffle, so a URL that makes up
    a third of all rows costs one row per map task.
    """
    slim = pages.select(normalize_url(F.col("url")).alias("normalized_url"), F.col(seq).alias("first_seq"))
    named = slim.where(F.col("normalized_url").isNotNull()).groupBy("normalized_url")
    unnamed = slim.where(F.col("normalized_url").isNull()).select("first_seq")
    return named.agg(F.min("first_seq").alias("first_seq")).select("first_seq").unionAll(unnamed)


def only_first(rows: DataFrame, firsts: DataFrame, seq: str = "seq") -> DataFrame:
    """The rows that `first_arrivals` named. `rows` may be anything made from the pages that still
    carries their `seq`: extracted records are far narrower to move than pages are."""
    return rows.join(firsts.select(F.col("first_seq").alias(seq)), seq, "left_semi")


def dedup_urls(pages: DataFrame, mode: str = "mark", seq: str = "seq") -> DataFrame:
    """First arrival per canonical URL, by `seq` (unique per row).

    `drop` keeps first arrivals only. `mark` keeps every row; later ones lose what was fetched and
    carry the duplicate error. A failed first fetch still counts as the first arrival. Rows meet
    their verdict on the unique `seq`, never on the URL, so no task receives a whole group.
    """
    firsts = first_arrivals(pages, seq)
    named = with_normalized_url(pages)
    if mode == "drop":
        return only_first(named, firsts, seq)
    if mode != "mark":
        raise ValueError(f"mode must be 'mark' or 'drop', not {mode!r}")
    tagged = named.join(firsts, named[seq] == firsts["first_seq"], "left")
    later = F.col("first_seq").isNull()
    blanked = {c: F.when(~later, F.col(c)) for c in _FETCHED if c in pages.columns}
    error = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    marked = tagged.withColumns({**blanked, "error": F.when(later, DUPLICATE).otherwise(error)})
    return marked.drop("first_seq")


def url_filter(urls: DataFrame, *by: str, words: int = FILTER_WORDS) -> DataFrame:
    """(`by`, word, bits): a Bloom filter over `urls.normalized_url`, one per value of `by` (a partition's name).

    A URL sets three bits of one 64-bit word. Filters have at most `words` rows whatever they hold, and filters of the
    same size merge by `merged_filter`: keep one beside each partition of a history, and the history need not be read again.
    """
    word, bits = _place(F.col("normalized_url"), words)
    named = urls.where(F.col("normalized_url").isNotNull())
    return named.select(*by, word.alias("word"), bits.alias("bits")).groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def merged_filter(filters: DataFrame) -> DataFrame:
    """One filter over everything the given ones hold."""
    return filters.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _place(url: Column, words: int) -> tuple[Column, Column]:
    """The word of a URL and its bits in that word."""
    h = F.xxhash64(url)
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, n).bitwiseAND(63).cast("int")) for n in (40, 46, 52)]
    return F.pmod(h, F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def split_by_filter(named: DataFrame, known: DataFrame, words: int = FILTER_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows the filter rules out, rows it may hold). Neither moves: the filter, `words` rows at most, is broadcast."""
    word, bits = _place(F.col("normalized_url"), words)
    small = F.broadcast(known.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    met = named.join(small, word == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(bits) == bits, F.lit(False))
    return met.where(~maybe).select(named.columns), met.where(maybe).select(named.columns)


def skip_seen(pages: DataFrame, seen: DataFrame, known: DataFrame | None = None, words: int = FILTER_WORDS) -> DataFrame:
    """Rows whose canonical URL is not in `seen.normalized_url`; rows without a URL stay.

    `known` is the merged filter of the history, if it was kept (of the same `words`); else it is made from `seen`. What it rules out
    is new and is never shuffled. Possible hits meet the history: their distinct URLs are looked up and staged, and the
    rows then meet one row per URL in a join of two plain shuffles, the only kind that is split at run time where a URL
    has a third of all rows. A full filter rules out less and loses nothing.
    """
    named = with_normalized_url(pages)
    new, maybe = split_by_filter(named, known if known is not None else url_filter(seen, words=words), words)
    asked = maybe.select("normalized_url").distinct()
    found = staged(asked.join(seen.select("normalized_url"), "normalized_url", "left_semi"), "seen-urls")
    return new.unionByName(maybe.join(found, "normalized_url", "left_anti"))


def drop_failed(pages: DataFrame) -> DataFrame:
    """Rows without an error."""
    return pages.where(F.col("error").isNull())
