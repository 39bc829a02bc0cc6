"""Publication dates: parsing, ISO text and the freshness window.

Every parser works in UTC and takes the as-of time as an argument. A text is first reduced to its *shape*: digits,
letters and white space become one sign each. Shapes are looked up in a dictionary of the usual notations, which
names the one format the text is read with; so nearly every date costs one translation, one lookup and one
parse, in generated code. Unusual spellings of the accepted notations, and only they, are recognised by patterns and
rewritten to `year|month|day|hour|minute|second|offset`. Nothing can raise under ANSI mode.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork.functions.text import SPACE_CLASS, bind, py_strip

_S = f"[{SPACE_CLASS}]"
_MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_MONTH_ABBR = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_MONTH_ORDER = "janfebmaraprmayjunjulaugsepoctnovdec"
_OFFSET = r"([+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?|Z)"

# The notations accepted, with the order of their groups.
RELATIVE = rf"(?i)(\d+){_S}+(second|sec|minute|min|hour|hr|day|week|month)s?{_S}+ago"
ISO = (
    rf"(?s)^(\d{{4}})(?:-(\d\d)-(\d\d)|(\d\d)(\d\d))"
    rf"(?:Z|.(\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d+)?)?)?{_OFFSET}?)?$"
)
LOOSE = (
    r"(?i)^(\d{4})-(\d{1,2})-(\d{1,2})"
    rf"(?:T(\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}})(?:\.\d{{1,6}}(?=Z$))?{_OFFSET}?)?$"
)
SLASHED = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
DAY_FIRST = rf"(?i)^(\d{{1,2}}){_S}+{_MONTH}{_S}+(\d{{4}})$"
MONTH_FIRST = rf"(?i)^{_MONTH}{_S}+(\d{{1,2}}),{_S}+(\d{{4}})$"
MAIL = (
    rf"(?i)^(?:mon|tue|wed|thu|fri|sat|sun),{_S}+(\d{{1,2}}){_S}+{_MONTH_ABBR}{_S}+(\d{{4}})"
    rf"{_S}+(\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}}){_S}+(?:GMT|{_OFFSET})$"
)
_REWRITES = (
    (ISO, "$1|$2$4|$3$5|$6|$7|$8|$9"),
    (LOOSE, "$1|$2|$3|$4|$5|$6|$7"),
    (SLASHED, "$1|$2|$3||||"),
    (DAY_FIRST, "$3|$2|$1||||"),
    (MONTH_FIRST, "$3|$1|$2||||"),
    (MAIL, "$3|$2|$1|$4|$5|$6|$7"),
)
# The units of relative phrases, in seconds.
_UNIT_SECONDS = (
    ("sec", 1), ("min", 60), ("hour", 3600), ("hr", 3600),
    ("day", 86400), ("week", 7 * 86400), ("month", 30 * 86400),
)
ISO_OUTPUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def utc_literal(as_of: datetime | Column) -> Column:
    """The as-of time as a timestamp column. A naive value is UTC, an aware one is converted."""
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    micros = int(as_of.timestamp()) * 1_000_000 + as_of.microsecond
    return F.timestamp_micros(F.lit(micros))


def _number(part: Column, default: int | None = None) -> Column:
    value = part.try_cast("int")
    return value if default is None else F.when(part == "", default).otherwise(value)


def _offset_seconds(part: Column) -> Column:
    digits = F.rpad(F.regexp_replace(F.substring_index(part, ".", 1), "[^0-9]", ""), 6, "0")
    size = (
        F.substring(digits, 1, 2).try_cast("int") * 3600
        + F.substring(digits, 3, 2).try_cast("int") * 60
        + F.substring(digits, 5, 2).try_cast("int")
    )
    plain = (part == "") | (F.upper(part) == "Z")
    return F.when(plain, 0).when(part.startswith("-"), -size).otherwise(size)


def _build(parts: Column) -> Column:
    month_text = F.lower(F.substring(parts[1], 1, 3))
    named = ((F.instr(F.lit(_MONTH_ORDER), month_text) + 2) / 3).cast("int")
    month = F.when(month_text < "a", _number(parts[1])).otherwise(named)
    local = F.try_make_timestamp(
        _number(parts[0]),
        month,
        _number(parts[2]),
        _number(parts[3], 0),
        _number(parts[4], 0),
        F.coalesce(_number(parts[5], 0), F.lit(0)).cast("decimal(16,6)"),
        F.lit("UTC"),
    )
    zero = F.lit(0)
    return F.try_subtract(local, F.make_dt_interval(zero, zero, zero, _offset_seconds(parts[6])))


# The years 1 to 9999, in microseconds since 1970.
_FIRST = int(datetime(1, 1, 1, tzinfo=timezone.utc).timestamp()) * 1_000_000
_LAST = int(datetime(9999, 12, 31, 23, 59, 59, tzinfo=timezone.utc).timestamp()) * 1_000_000 + 999_999


def _within_calendar(ts: Column) -> Column:
    """Null outside the years 1 to 9999."""
    return bind(ts, lambda t: F.when(F.unix_micros(t).between(_FIRST, _LAST), t))


# Words a relative phrase may name a unit with.
_UNIT_WORDS = ("second", "sec", "minute", "min", "hour", "hr", "day", "week", "month")


def _relative(text: Column, as_of: datetime | Column) -> Column:
    """`N unit ago` counted back from the as-of time; null where the text holds no such phrase."""
    known = dict(_UNIT_SECONDS)
    units = [F.lit(x) for w in _UNIT_WORDS for x in (w, next(n for stem, n in known.items() if w.startswith(stem)))]
    seconds = F.try_element_at(F.create_map(*units), F.lower(F.regexp_extract(text, RELATIVE, 2)))
    amount = F.regexp_extract(text, RELATIVE, 1).try_cast("bigint")
    # Far beyond year 1 from any date, and small enough for the product to stay in range.
    limit = 400_000_000_000
    zero = F.lit(0)

    def back(span: Column) -> Column:
        past = F.make_dt_interval(zero, zero, zero, span.cast("decimal(18,6)"))
        return F.when(span <= limit, F.try_subtract(utc_literal(as_of), past))

    return bind(F.when(amount <= limit, amount) * seconds, back)


def parse_relative_date(text: Column, as_of: datetime | Column) -> Column:
    """Timestamp of the first `N unit ago` found anywhere in the text, or null."""
    return _within_calendar(_relative(text, as_of))


def _shapes() -> dict[str, str]:
    """Shape -> format, for the usual spellings of the accepted notations."""
    shapes = {"00000000": "yyyyMMdd"}
    for mark in "-/":
        for month in ("00", "0"):
            for day in ("00", "0"):
                shapes[f"0000{mark}{month}{mark}{day}"] = f"yyyy{mark}M{mark}d"
    zones = {"": "", "a": "'Z'", "+00:00": "XXX", "-00:00": "XXX", "+0000": "XX", "-0000": "XX"}
    clocks = {"00:00:00": "HH:mm:ss", "00:00": "HH:mm", "00:00:00.000": "HH:mm:ss.SSS", "00:00:00.000000": "HH:mm:ss.SSSSSS"}
    for gap, between in (("a", "'T'"), (" ", " ")):
        for clock, time in clocks.items():
            for zone, offset in zones.items():
                shapes[f"0000-00-00{gap}{clock}{zone}"] = f"yyyy-MM-dd{between}{time}{offset}"
    for day in ("0", "00"):
        for length in range(3, 10):
            name, month = "a" * length, "MMM" if length == 3 else "MMMM"
            shapes[f"{day} {name} 0000"] = f"d {month} yyyy"
            shapes[f"{name} {day}, 0000"] = f"{month} d, yyyy"
        for zone, offset in (("aaa", "'GMT'"), ("+0000", "XX"), ("-0000", "XX")):
            shapes[f"{_CUT}{day} aaa 0000 00:00:00 {zone}"] = f"d MMM yyyy HH:mm:ss {offset}"
    return shapes


# Weekdays, and the sign that stands for one cut off from the front of a text.
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
_CUT = "@"
_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _usual(text: Column) -> Column:
    """The timestamp of a text in one of the usual spellings, or null."""
    shapes = _shapes()
    formats = list(dict.fromkeys(shapes.values()))
    numbers = F.create_map(*[F.lit(x) for shape, form in shapes.items() for x in (shape, formats.index(form))])

    def read(place: Column, body: Column) -> Column:
        # Each format is a constant, so its reader is made once.
        number = F.try_element_at(numbers, F.concat(place, F.translate(body, _DIGITS + _LETTERS + _LETTERS.upper(), "0" * 10 + "a" * 52)))

        def by_number(n: Column) -> Column:
            chosen = F.when(n == 0, F.try_to_timestamp(body, F.lit(formats[0])))
            for i, form in enumerate(formats[1:], 1):
                chosen = chosen.when(n == i, F.try_to_timestamp(body, F.lit(form)))
            return F.when(n.isNotNull(), chosen)

        return bind(number, by_number)

    # A weekday is not checked against its date, so it is cut off before the rest is read.
    cut = (F.substring(text, 4, 2) == ", ") & F.lower(F.left(text, F.lit(3))).isin(*WEEKDAYS)
    return F.when(cut, bind(F.substr(text, F.lit(6)), lambda body: read(F.lit(_CUT), body))).otherwise(read(F.lit(""), text))


def _unusual(text: Column, as_of: datetime | Column) -> Column:
    """Relative phrases, and the notations in any accepted spelling."""
    notation = F.coalesce(*[F.when(text.rlike(p), F.regexp_replace(text, p, to)) for p, to in _REWRITES])
    absolute = bind(F.split(notation, r"\|"), _build)
    known = F.when(text.rlike(RELATIVE), _relative(text, as_of)).otherwise(absolute)
    return F.when(F.translate(text, _DIGITS, "") != text, known)


def parse_timestamp(text: Column, as_of: datetime | Column) -> Column:
    """Like `parse_date`, as a timestamp (UTC, whole seconds). The session's zone must be UTC."""
    found = bind(py_strip(text), lambda clean: F.coalesce(_usual(clean), _unusual(clean, as_of)))
    return F.date_trunc("second", _within_calendar(found))


def format_iso_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUTPUT)


def parse_date(text: Column, as_of: datetime | Column) -> Column:
    """ISO text in UTC: relative phrase first, then ISO, then the other notations, else null."""
    return format_iso_utc(parse_timestamp(text, as_of))


def fresh_at(published: Column, as_of: datetime | Column, hours: int = 24) -> Column:
    """Freshness of a timestamp: 0 <= as_of - published <= hours, false for null."""
    window = hours * 3600 * 1_000_000
    # 0 <= age <= window, with the age named once.
    age = F.unix_micros(utc_literal(as_of)) - F.unix_micros(published)
    return F.coalesce(F.abs(age * 2 - window) <= window, F.lit(False))


def is_fresh(text: Column, as_of: datetime | Column, hours: int = 24) -> Column:
    """Freshness of a date text in any accepted notation."""
    return fresh_at(parse_timestamp(text, as_of), as_of, hours)
