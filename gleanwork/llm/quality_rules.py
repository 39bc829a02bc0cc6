"""Line-first quality rules, in DataFrame functions only.

Every line is judged alone: punctuation (words carry symbols, marks come in runs, nothing but marks, or more
than half of five words or more are capitals), navigation (a menu: bars or arrows between short labels) and
boilerplate (notices every site repeats).
Failing lines are removed. A document is rejected when too much of its text went with them, when it is
too short, or when it mostly repeats itself.

The shape of the code matters at scale: each value that is used more than once is bound by a one-element
transform, and repeated word windows are found by sorting an array of hashes once, so that a text of any
length costs n log n and nothing is exploded or shuffled.

Defined results
---------------
* A null or empty text has no words, fails the base rules and is rejected; its cleaned text is null or
  empty as it was.
* Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and return.
* Repeated windows are compared by 64-bit hashes of their three words.
* Lines are split at line feeds only. A text that loses no line is returned as it was.
* Empty tables, nulls in other columns, repeated rows and further columns need no care: each row is
  judged by its own text, and the result columns are named by the caller where they may clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words, and the symbols that are counted.
SPACES = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
# Marks repeated three times or more, words of two capitals or more without a small letter, separators of menus.
RUNS = "[!?.]{3,}"
LOUD = rf"(?<![^{SPACES}])[^{SPACES}\p{{Ll}}]*\p{{Lu}}[^{SPACES}\p{{Ll}}]*\p{{Lu}}[^{SPACES}\p{{Ll}}]*(?![^{SPACES}])"
SEPARATOR = "[|»›•→]"
# Phrases of notices that many pages repeat (lower case).
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "we use cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "javascript is disabled",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "click here to",
    "share on facebook",
    "skip to content",
)

MIN_WORDS = 50
MAX_REPEATED = 0.5  # share of words inside a window of three that occurs again
MAX_LOST = 0.3  # share of word characters that may go with failing lines
WORDS_FOR_SYMBOLS = 4  # a line with one symbol or more for each so many words fails
WORDS_FOR_SHOUTING = 5  # shorter lines may be in capitals
CHARS_FOR_RUNS = 4  # a line fails when runs of marks are a fourth of its characters or more
WORDS_IN_LABEL = 4  # a menu's labels have so many words on average at most
BOILERPLATE_CHARS = 300  # a longer line is prose that mentions such a phrase


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), "")


def repeated_words(tokens: Column) -> Column:
    """Number of words inside a window of three that occurs twice or more, its first place included."""

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def places(windows: Column) -> Column:
        twice = F.filter(
            windows,
            lambda w, i: (w["h"] == F.get(windows, i - 1)["h"]) | (w["h"] == F.get(windows, i + 1)["h"]),
        )
        return F.array_sort(F.transform(twice, lambda w: w["p"]))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def count(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        found = bind(marked, lambda m: bind(places(m), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)

    return F.when(F.size(tokens) < 3, F.lit(0).cast("long")).otherwise(bind(windows(tokens), count))


def bad_punctuation(line: Column) -> Column:
    """Symbols hang on the words, marks come in runs, nothing but marks, or most words are capitals.

    Each rule looks for its sign first and counts on the few lines that have it.
    """
    n_words = F.regexp_count(line, F.lit(f"[^{SPACES}]+"))
    n_symbols = F.regexp_count(line, F.lit(SYMBOLS))
    symbols = line.rlike(SYMBOLS) & (n_symbols * WORDS_FOR_SYMBOLS >= n_words)
    run_chars = F.length(line) - F.length(F.regexp_replace(line, RUNS, ""))
    runs = line.rlike(RUNS) & (run_chars * CHARS_FOR_RUNS >= F.length(F.regexp_replace(line, f"[{SPACES}]", "")))
    bare = line.rlike(f"[^{SPACES}]") & ~line.rlike(r"[\p{L}\p{N}]")
    loud = F.regexp_count(line, F.lit(LOUD))
    shouts = line.rlike(LOUD) & (n_words >= WORDS_FOR_SHOUTING) & (2 * loud > n_words)
    return symbols | runs | bare | shouts


def is_navigation(line: Column) -> Column:
    """A menu: three separators or more, with or without blanks around, between labels of a few words."""
    bars = F.regexp_count(line, F.lit(SEPARATOR))
    words = F.regexp_count(line, F.lit(rf"[^{SPACES}|»›•→]+"))
    return line.rlike(SEPARATOR) & (bars >= 3) & (words <= WORDS_IN_LABEL * (bars + 1))


def is_boilerplate(line: Column) -> Column:
    """A short line with a phrase of the list above."""
    return (F.length(line) <= BOILERPLATE_CHARS) & F.lower(line).rlike("|".join(BOILERPLATE))


def failing(line: Column) -> Column:
    return bad_punctuation(line) | is_navigation(line) | is_boilerplate(line)


def _word_chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), "")).cast("long")


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with one struct `quality` added: the counts, the verdicts and the cleaned text.

    An existing column of that name is replaced.
    """
    return docs.withColumn("quality", _judged(text))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `quality_rules` that are kept.

    Rejected rows leave as empty arrays and not by a filter, which would work the verdict out a second time.
    """
    return docs.withColumn("quality", F.explode(F.filter(F.array(_judged(text)), lambda q: q["kept"])))


def _judged(text: str) -> Column:
    body = F.col(f"`{text}`")

    def judged(w: Column) -> Column:
        n_words = F.size(w).cast("long")
        return bind(repeated_words(w), lambda r: F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(F.coalesce(body, F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            r.alias("n_repeat_words"),
            ((n_words < MIN_WORDS) | (r > MAX_REPEATED * n_words)).alias("base_failed"),
        ))

    def by_line(lines: Column) -> Column:
        filled = F.filter(lines, lambda line: line.rlike(f"[^{SPACES}]"))

        def cleaned(flags: Column, gone: Column) -> Column:
            left = F.array_join(F.filter(lines, lambda line, i: ~F.get(flags, i)), "\n")
            return F.struct(
                F.size(gone).cast("long").alias("n_removed_lines"),
                F.when(F.size(gone) == 0, F.lit(0).cast("long"))
                .otherwise(_word_chars(F.array_join(gone, " "))).alias("removed_chars"),
                F.when(F.size(gone) == 0, body).otherwise(left).alias("cleaned_text"),
            )

        def shown(flags: Column) -> Column:
            removed = F.filter(lines, lambda line, i: F.get(flags, i))
            return bind(filled, lambda f: bind(removed, lambda gone: F.struct(
                (F.size(f) - F.size(F.array_distinct(f))).cast("long").alias("n_dup_lines"),
                cleaned(flags, gone).alias("clean"),
            )))

        return bind(F.transform(lines, failing), shown)

    def verdict(base: Column, lines: Column) -> Column:
        clean = lines["clean"]
        lost = clean["removed_chars"] > MAX_LOST * base["word_chars"]
        return F.struct(
            *[base[c].alias(c) for c in ("n_words", "word_chars", "n_symbols")],
            lines["n_dup_lines"].alias("n_dup_lines"),
            *[base[c].alias(c) for c in ("n_repeat_words", "base_failed")],
            (~base["base_failed"] & ~lost).alias("kept"),
            *[clean[c].alias(c) for c in ("n_removed_lines", "removed_chars", "cleaned_text")],
        )

    base = bind(words(body), judged)
    lines = bind(F.split(F.coalesce(body, F.lit("")), "\n"), by_line)
    return bind(base, lambda b: bind(lines, lambda n: verdict(b, n)))
