"""Small text columns shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimmed as white space (Unicode white space and the four
# ASCII separators), and the same set as the inside of a regex character class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` mentions it.

    An expression mentioned twice is computed twice inside conditional branches; a one-element
    transform names it instead.
    """
    return F.transform(F.array(value), use)[0]


def py_strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def truthy(c: Column) -> Column:
    """The text, with empty text turned into null."""
    return F.when(c != "", c)


def strip_title_prefix(c: Column) -> Column:
    """Trim and drop a leading `title:` in any case."""
    return py_strip(F.regexp_replace(py_strip(c), r"(?i)^title:", ""))


def join_authors(authors: Column) -> Column:
    return F.array_join(F.coalesce(authors, F.array().cast("array<string>")), ", ")


def encode_authors(authors: Column) -> Column:
    return F.to_json(F.coalesce(authors, F.array().cast("array<string>")))


def decode_authors(text: Column) -> Column:
    """JSON text to array; null or broken text gives an empty array."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))
