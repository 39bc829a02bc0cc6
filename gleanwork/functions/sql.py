"""The main scalar functions for `spark.sql`.

`register_sql` declares them as temporary SQL functions. Catalyst inlines their bodies, so they
optimise like any other expression. The patterns are the ones the column functions use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gleanwork.functions import dates, names, repos, urls
from gleanwork.functions.text import SPACE_CLASS, WHITESPACE


def _raw(pattern: str) -> str:
    """A pattern as raw SQL text."""
    return f"r'{pattern}'"


def _let(name: str, value: str, body: str) -> str:
    """`body` with `name` standing for `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _strip(x: str) -> str:
    return "btrim({}, '{}')".format(x, "".join(f"\\u{ord(c):04x}" for c in WHITESPACE))


def _normalize_url() -> str:
    params = _raw(urls._PARAMS)
    schemes = ", ".join(f"'{s}'" for s in urls.PARAM_SCHEMES)
    parted = (
        f"concat(rtrim('/', regexp_replace(p[2], {params}, '$1')),"
        f" if(regexp_extract(p[2], {params}, 2) <> '', concat(';', regexp_extract(p[2], {params}, 2)), ''))"
    )
    path = f"if(contains(p[2], ';') AND lower(p[0]) IN ({schemes}), {parted}, rtrim('/', p[2]))"
    pairs = f"filter(split(substr(page, length(substring_index(page, '?', 1)) + 2), '&'), q -> q <> '' AND NOT q RLIKE {_raw(urls._TRACKING_PAIR)})"
    query = _let("qs", f"if(contains(page, '?'), array_join(array_sort({pairs}), '&'), '')", "if(qs <> '', concat('?', qs), '')")
    head = "if(p[0] <> '', concat(lower(p[0]), ':'), ''), lower(p[1])"
    parts = f"split(regexp_replace(substring_index(page, '?', 1), {_raw(urls._PARTS)}, '$1\\u0000$2\\u0000$3'), '\\u0000', 3)"
    page = f"substring_index(translate({_strip('x')}, '\\t\\r\\n', ''), '#', 1)"
    return _let("page", page, _let("p", parts, f"concat({head}, {path}, {query})"))


def _normalize_entity_name() -> str:
    word, space = names._WORD, SPACE_CLASS
    plain = f"regexp_replace(lower({_strip('x')}), {_raw(f'[^{word}{space}]')}, '')"
    return f"coalesce(btrim(regexp_replace(regexp_replace({plain}, {_raw(names._LEGAL)}, ''), {_raw(f'[{space}]+')}, ' ')), '')"


def _timestamp() -> str:
    """UTC timestamp of the date text `x`, null where it is none."""
    unit = f"lower(regexp_extract(c, {_raw(dates.RELATIVE)}, 2))"
    seconds = " ".join(f"WHEN contains({unit}, '{word}') THEN {n}" for word, n in dates._UNIT_SECONDS)
    amount = f"try_cast(regexp_extract(c, {_raw(dates.RELATIVE)}, 1) AS BIGINT)"
    limit = 400_000_000_000
    back = f"if(s <= {limit}, try_subtract(as_of, make_dt_interval(0, 0, 0, CAST(s AS DECIMAL(18, 6)))), NULL)"
    relative = _let("s", f"if({amount} <= {limit}, {amount}, NULL) * CASE {seconds} END", back)

    cases = " ".join(f"WHEN c RLIKE {_raw(p)} THEN regexp_replace(c, {_raw(p)}, '{to}')" for p, to in dates._REWRITES)
    month = (
        "CASE WHEN lower(p[1]) < 'a' THEN try_cast(p[1] AS INT)"
        f" ELSE CAST((instr('{dates._MONTH_ORDER}', lower(substr(p[1], 1, 3))) + 2) / 3 AS INT) END"
    )
    clock = [f"if(p[{i}] = '', 0, try_cast(p[{i}] AS INT))" for i in (3, 4, 5)]
    local = (
        f"try_make_timestamp(try_cast(p[0] AS INT), {month}, try_cast(p[2] AS INT), {clock[0]}, {clock[1]},"
        f" CAST({clock[2]} AS DECIMAL(16, 6)), 'UTC')"
    )
    digits = "rpad(regexp_replace(substring_index(p[6], '.', 1), '[^0-9]', ''), 6, '0')"
    size = " + ".join(f"CAST(substr({digits}, {at}, 2) AS INT) * {n}" for at, n in ((1, 3600), (3, 60), (5, 1)))
    offset = f"CASE WHEN upper(p[6]) IN ('', 'Z') THEN 0 WHEN startswith(p[6], '-') THEN -({size}) ELSE {size} END"
    absolute = _let("p", f"split(CASE {cases} END, r'\\|')", f"try_subtract({local}, make_dt_interval(0, 0, 0, {offset}))")
    found = f"if(c RLIKE {_raw(dates.RELATIVE)}, {relative}, {absolute})"
    return f"date_trunc('second', {_let('c', _strip('x'), _let('t', found, 'if(year(t) BETWEEN 1 AND 9999, t, NULL)'))})"


def _is_fresh() -> str:
    window = "coalesce(d <= as_of AND d >= as_of - INTERVAL 24 HOURS, false)"
    return _let("d", _timestamp(), window)


def register_sql(spark: SparkSession) -> None:
    """normalize_url(x), normalize_entity_name(x), github_repo(x), valid_url(x), parse_date(x, as_of), is_fresh(x, as_of)."""
    link = _raw(repos.REPO_LINK)
    repo = (
        f"if(x RLIKE {link}, struct(regexp_extract(x, {link}, 1) AS owner,"
        f" regexp_replace(regexp_extract(x, {link}, 2), r'\\.git$', '') AS repo), NULL)"
    )
    bodies = {
        "normalize_url(x STRING)": _normalize_url(),
        "normalize_entity_name(x STRING)": _normalize_entity_name(),
        "github_repo(x STRING)": repo,
        "valid_url(x STRING)": f"coalesce({_strip('x')} RLIKE {_raw(urls.VALID_URL)}, false)",
        "parse_date(x STRING, as_of TIMESTAMP)": f"date_format({_timestamp()}, \"{dates.ISO_OUTPUT}\")",
        "is_fresh(x STRING, as_of TIMESTAMP)": _is_fresh(),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
