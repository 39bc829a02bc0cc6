"""URL columns: canonical form, host, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork.functions.text import SPACE_CLASS, bind, py_strip

# Query keys that only track visits, and the schemes whose last path segment
# may carry `;params`.
TRACKING_PREFIX = "utm_"
TRACKING_KEYS = ("ref", "source", "fbclid")
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
    "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

# Scheme, authority with its slashes, and path of a URL without query and fragment.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/]*)?(.*)$"
_TRACKING_PAIR = rf"(?i)^(?:{TRACKING_PREFIX}[^=]*|{'|'.join(TRACKING_KEYS)})(?:=|$)"
_PARAMS = r"(?s)^((?:.*/)?[^/;]*);([^/]*)$"
# The plain-ASCII run in front of the wide class only makes the common case fast.
VALID_URL = rf"^[hH][tT][tT][pP][sS]?://[^{SPACE_CLASS}/$.?#][^\n][!-~]*+[^{SPACE_CLASS}]*+\z"


def is_tracking_param(key: Column) -> Column:
    low = F.lower(key)
    return low.startswith(TRACKING_PREFIX) | low.isin(*TRACKING_KEYS)


def _clean_query(query: Column) -> Column:
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(_TRACKING_PAIR))
    return F.array_join(F.array_sort(kept), "&")


def _clean_path(scheme: Column, path: Column) -> Column:
    """Path without closing slashes; `;params` of the last segment stay behind it."""
    slashless = F.rtrim(F.regexp_replace(path, _PARAMS, "$1"), F.lit("/"))
    params = F.regexp_extract(path, _PARAMS, 2)
    parted = F.concat(slashless, F.when(params != "", F.concat(F.lit(";"), params)).otherwise(""))
    return F.when(path.contains(";") & scheme.isin(*PARAM_SCHEMES), parted).otherwise(F.rtrim(path, F.lit("/")))


def _canonical(page: Column) -> Column:
    base = F.substring_index(page, "?", 1)
    parts = F.split(F.regexp_replace(base, _PARTS, "$1\x00$2\x00$3"), "\x00", 3)
    query = F.when(page.contains("?"), _clean_query(F.substr(page, F.length(base) + 2))).otherwise("")

    def assemble(p: Column) -> Column:
        scheme = F.lower(p[0])
        return F.concat(
            F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
            F.lower(p[1]),
            _clean_path(scheme, p[2]),
            bind(query, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")),
        )

    return bind(parts, assemble)


def normalize_url(url: Column) -> Column:
    """Canonical form used as the dedup key; null stays null."""
    return bind(F.substring_index(F.translate(py_strip(url), "\t\r\n", ""), "#", 1), _canonical)


def url_host(url: Column) -> Column:
    """Authority part in lower case, with port and user info; empty where there is none."""
    return F.lower(F.regexp_extract(py_strip(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def valid_url(url: Column) -> Column:
    """True for a well-formed http(s) URL; null and empty are false."""
    return F.coalesce(py_strip(url).rlike(VALID_URL), F.lit(False))
