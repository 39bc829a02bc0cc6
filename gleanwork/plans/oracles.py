"""For each registered query the same answer in plain SQL, worked out from the raw columns."""

from __future__ import annotations

_AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# Canonical form of the URL `u`, as a chain of CTEs ending in `canon(id, normalized_url, u)`.
_CANON = """
cut AS (SELECT id, u, regexp_replace(trim(u), '#.*$', '') AS page FROM src),
part AS (SELECT id, u, split_part(page, '?', 1) AS base,
    CASE WHEN strpos(page, '?') > 0 THEN substr(page, strpos(page, '?') + 1) ELSE '' END AS q FROM cut),
piece AS (SELECT id, u, lower(regexp_extract(base, '^([A-Za-z]+)://', 1)) AS scheme,
    lower(regexp_extract(base, '//([^/]*)', 1)) AS host, regexp_replace(base, '^[A-Za-z]+://[^/]*', '') AS path,
    list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(
        lower(split_part(x, '=', 1)), '^(utm_.*|ref|source|fbclid)$'))) AS pairs FROM part),
canon AS (SELECT id, u, scheme || '://' || host || rtrim(path, '/')
    || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END AS normalized_url FROM piece)
"""
_TWINS = """src AS (SELECT 2 * page_id AS id, url AS u, html FROM pages UNION ALL
    SELECT 2 * page_id + 1, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_campaign=' || page_id, html FROM pages),""" + _CANON
_PLACED = f"""WITH {_TWINS},
placed AS (SELECT id, u, normalized_url, row_number() OVER (PARTITION BY normalized_url ORDER BY id) AS place FROM canon)"""
# A cut-off `&amp` without its semicolon counts as well.
_UNESCAPE = "regexp_replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"


def _tag(name: str) -> str:
    return "trim(" + _UNESCAPE.format(f"regexp_extract(html, '<{name}>(.*?)</{name}>', 1, 's')") + ")"


_CLEANED = (
    r"regexp_replace(regexp_replace(html, '(?s)<(script|style|nav|footer)\b.*?</(script|style|nav|footer)>', ' ', 'g'),"
    r" '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')"
)
_SITE = "regexp_extract(regexp_replace(url, '^[^:]*://', ''), '^([^/?#]*)', 1)"

# -- dates --

_PRINTED = f"""
CASE WHEN o_orderkey % 14 = 13 THEN NULL
WHEN o_orderkey % 14 IN (0, 2, 3, 11) THEN strftime(moment, {_ISO})
WHEN o_orderkey % 14 = 1 THEN strftime(moment - INTERVAL '5 hours 30 minutes', {_ISO})
WHEN o_orderkey % 14 = 10 THEN strftime(moment + INTERVAL 8 HOURS, {_ISO})
ELSE strftime(day, {_ISO}) END"""
_FRESH_AT = f"ts <= {_AS_OF} AND date_trunc('second', ts) >= {_AS_OF} - INTERVAL 24 HOURS"

# -- names --

_LOST = "substr(p_name, 1, length(p_name) // 2) || substr(p_name, length(p_name) // 2 + 2)"
_INITCAP = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_RESOLVED = f"""
SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN 'Nick ' || (p_partkey % 25) || ', Inc.' WHEN 1 THEN upper(p_name) || ' Ltd.'
    WHEN 2 THEN trim({_LOST}) WHEN 3 THEN 'zzqx' || (p_partkey % 7) WHEN 4 THEN '###' ELSE ' ' END AS raw_name,
  'STARTUP' AS entity_type, 'https://x.example/' || p_partkey AS source_url,
  CASE p_partkey % 6 WHEN 0 THEN (SELECT n_name FROM nation WHERE n_nationkey = p_partkey % 25)
    WHEN 1 THEN {_INITCAP} WHEN 2 THEN {_INITCAP} WHEN 3 THEN 'zzqx' || (p_partkey % 7) WHEN 4 THEN '###' ELSE 'Unknown' END AS canonical_name,
  CASE p_partkey % 6 WHEN 0 THEN 'alias' WHEN 1 THEN 'normalized' WHEN 2 THEN 'fuzzy' ELSE 'unresolved' END AS resolution_method,
  CASE p_partkey % 6 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE
    WHEN 2 THEN round(2 * (length(p_name) - 1) / (2.0::DOUBLE * length(p_name) - 1), 2)
    WHEN 3 THEN CASE WHEN list_has_any((SELECT list(DISTINCT c) FROM (SELECT unnest(string_split(p_name, '')) AS c FROM part)),
      ['z', 'q', 'x', (p_partkey % 7)::VARCHAR]) THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END
    ELSE 0.0::DOUBLE END AS confidence
FROM part"""

# -- validation --


def _list(*rules: tuple[str, str]) -> str:
    """Names of the rules whose condition for failing holds."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in rules) + ")"


def _source(key: str, n: int) -> tuple[str, str]:
    return "source.url", f"{key} % {n} IN (0, 1)"


_STARTUP_REASONS = _list(
    ("recordType", "s_suppkey % 11 = 0"), _source("s_suppkey", 9), ("content.entityName", "s_suppkey % 7 IN (0, 1)"),
    ("content.data.employeeCount", "s_suppkey % 5 = 0"),
)
_PRODUCT_REASONS = _list(
    ("recordType", "p_partkey % 11 = 0"), _source("p_partkey", 13), ("content.startupName", "p_partkey % 7 = 0"),
    ("content.pricingModel", "p_partkey % 6 = 5"),
)
_PAPER_RULES = (
    ("recordType", "c_custkey % 17 = 0"), ("paper_url", "c_custkey % 5 = 0"), ("github_url", "c_custkey % 4 = 1"),
    ("github_stars", "c_custkey % 3 = 0"),
)
_POSTING_REASONS = _list(("recordType", "o_orderkey % 10 = 0"), _source("o_orderkey", 6))
_PRICE = "CASE p_partkey % 6 WHEN 0 THEN 'free' WHEN 1 THEN 'Freemium' WHEN 2 THEN 'PAID' WHEN 3 THEN 'enterprise' WHEN 5 THEN 'gratis' END"

# -- storage --

_PAPER_DELTA = f"""
SELECT o_orderkey AS seq, 'https://p.example/' || CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS paper_url,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'title ' || o_orderkey END AS title,
  CASE o_orderkey % 7 WHEN 0 THEN o_orderstatus ELSE '' END AS authors,
  CASE o_orderkey % 6 WHEN 0 THEN 'https://github.com/d/' || o_orderkey END AS github_url,
  CASE o_orderkey % 9 WHEN 0 THEN 0 WHEN 1 THEN o_orderkey % 1000 END AS github_stars,
  CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE strftime(o_orderdate, {_ISO}) END AS published_date
FROM orders WHERE o_orderkey % 4 <> 0"""


def _posting_oracle(kind: str) -> str:
    side = "company_name" if kind == "JOB" else "content_summary"
    fallback = "'Unknown'" if kind == "JOB" else "'Untitled'"
    return f"""
WITH r AS (SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 't' || o_orderkey END AS title,
    o_orderpriority AS side, 'https://n.example/' || CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE o_custkey END AS source_url,
    strftime(o_orderdate, {_ISO}) AS published_date, CASE o_orderkey % 7 WHEN 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS is_fresh
  FROM orders),
s AS (SELECT source_url, min(seq) + 1 AS id, arg_min(side, seq) AS side, arg_min(published_date, seq) AS published_date,
    min(seq) AS m FROM r WHERE seq % 10 = 1 GROUP BY source_url),
s2 AS (SELECT s.*, coalesce(r.title, 'stored') AS title, coalesce(r.is_fresh, false) AS is_fresh FROM s JOIN r ON r.seq = s.m),
d AS (SELECT source_url, min(seq) AS seq, arg_min(side, seq) AS side, arg_min(published_date, seq) AS published_date,
    arg_max(title, seq) FILTER (WHERE title IS NOT NULL) AS title, arg_max(is_fresh, seq) FILTER (WHERE is_fresh IS NOT NULL) AS is_fresh
  FROM r WHERE seq % 10 <> 1 GROUP BY source_url)
SELECT s2.id, CASE WHEN s2.id IS NULL THEN d.seq END AS seq, coalesce(s2.source_url, d.source_url) AS source_url,
  CASE WHEN s2.id IS NULL THEN d.side ELSE s2.side END AS {side}, coalesce(d.title, s2.title, {fallback}) AS title,
  CASE WHEN s2.id IS NULL THEN d.published_date ELSE s2.published_date END AS published_date,
  coalesce(d.is_fresh, s2.is_fresh, false) AS is_fresh
FROM s2 FULL JOIN d ON s2.source_url = d.source_url"""


_PAPER_RECORD = """
SELECT p_partkey AS k, 'https://papers.example/' || p_partkey AS paper_url,
  CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_name END AS title,
  CASE p_partkey % 4 WHEN 0 THEN p_brand || ', ' || p_type WHEN 1 THEN p_brand || ', ' || p_type ELSE '' END AS authors,
  CASE WHEN p_partkey % 4 IN (0, 1) THEN 'https://github.com/org' || (p_partkey % 40) || '/' || replace(p_name, ' ', '-') END AS github_url,
  CASE p_partkey % 4 WHEN 0 THEN printf('2023-%02d-%02dT00:00:00Z', p_partkey % 12 + 1, p_partkey % 28 + 1)
    WHEN 1 THEN printf('2023-02-%02dT00:00:00Z', p_partkey % 28 + 1) END AS published_date
FROM part"""

# -- exports --

_STAMP_US = "(round(c_acctbal * 1000000))::BIGINT"
_STAMPED = f"TIMESTAMP '2024-02-01' + to_microseconds({_STAMP_US})"
_STAMP = (
    f"CASE WHEN {_STAMP_US} % 1000000 = 0 THEN strftime({_STAMPED}, '%Y-%m-%dT%H:%M:%S')"
    f" ELSE strftime({_STAMPED}, '%Y-%m-%dT%H:%M:%S.%f') END"
)
_URL_S = "'https://s.example/' || c_custkey"


def _export(kind: str, columns: str) -> str:
    head = "" if kind == "entity_mappings" else f", '1.0' AS \"schemaVersion\", '{kind}' AS \"recordType\""
    return f"SELECT c_custkey AS id{head}, {columns} FROM customer"


_SOURCE_COLUMNS = f"'feed' AS \"sourceName\", {_URL_S} AS \"sourceUrl\""
_DATED_COLUMNS = f"'2024-01-01T00:00:00Z' AS \"publishedDate\", c_custkey % 2 = 0 AS \"isFresh\", {_STAMP} AS \"collectedAt\""
_QUOTED = "CASE c_custkey % 2 WHEN 0 THEN 'says \"a, b\"' END"

# -- responses --

_ANSWERS = """
WITH k AS (SELECT conv_id * 1000 + turn AS k, text FROM conversations),
p AS (SELECT * FROM k, (VALUES (0, 'primary'), (1, 'second'), (2, 'third')) v(priority, provider)),
a AS (SELECT k::VARCHAR AS request_id, text, priority, provider, (k // (3 ** priority)::BIGINT) % 3 AS state,
    k % 5 <> priority AS available FROM p),
m AS (SELECT request_id, arg_min(text, priority) FILTER (WHERE available AND state = 0) AS name,
    arg_min(provider, priority) FILTER (WHERE available AND state = 0) AS provider,
    string_agg('LLM provider ''' || provider || ''' failed: ' || CASE state WHEN 2 THEN 'timeout after ' || (priority + 1)
      ELSE 'Failed to parse JSON response from ' || provider || ': Expecting value: line 1 column 1 (char 0)' END, '; ' ORDER BY priority)
      FILTER (WHERE available AND state <> 0) AS misses FROM a GROUP BY request_id),
f AS (SELECT request_id, name, provider, CASE WHEN provider IS NULL THEN 'LLM Extraction failed across all providers: '
    || coalesce(misses, 'No LLM providers available or configured.') END AS error FROM m)"""

_CHUNKS = r"""
WITH RECURSIVE d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n\s*\n+', E'\n\n', 'g'), E' \n\t\r') AS t FROM documents),
w AS (
  SELECT doc_id, t, 0 AS start, least(SIZE, length(t)) AS stop FROM d WHERE t <> ''
  UNION ALL
  SELECT doc_id, t, nxt, least(nxt + SIZE, length(t)) FROM (
    SELECT doc_id, t, greatest(start + 1, cut - OVERLAP) AS nxt, cut FROM (
      SELECT *, CASE WHEN stop < length(t) AND brk > start + SIZE // 2 THEN brk + 1 ELSE stop END AS cut FROM (
        SELECT *, greatest(LAST_DOT, LAST_LINE) AS brk FROM w))
    WHERE cut < length(t))
),
c AS (SELECT doc_id, start, trim(substr(t, start + 1, CASE WHEN stop < length(t) AND brk > start + SIZE // 2 THEN brk + 1 ELSE stop END - start), E' \n\t\r') AS chunk
  FROM (SELECT *, greatest(LAST_DOT, LAST_LINE) AS brk FROM w)),
n AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1)::INTEGER AS chunk_no, chunk FROM c WHERE chunk <> '')
"""
_WINDOW = "substr(t, start + 1, stop - start)"


def _last(mark: str, backwards: str, width: int) -> str:
    """Start of the last occurrence in the window, -1 where there is none."""
    return (
        f"CASE WHEN strpos({_WINDOW}, {mark}) > 0 THEN start + (stop - start) - strpos(reverse({_WINDOW}), {backwards})"
        f" - {width - 1} ELSE -1 END"
    )


def _chunks(size: int, overlap: int) -> str:
    return (
        _CHUNKS.replace("LAST_DOT", _last("'. '", "' .'", 2)).replace("LAST_LINE", _last("E'\\n'", "E'\\n'", 1))
        .replace("SIZE", str(size)).replace("OVERLAP", str(overlap))
    )


ORACLES: dict[str, str] = {
    "normalize_url": f"WITH src AS (SELECT page_id AS id, url AS u FROM pages), {_CANON} SELECT id AS page_id, normalized_url FROM canon",
    "normalize_url_built": """
SELECT c_custkey, 'https://shop' || (c_custkey % 50) || '.example.com:8443/' || c_mktsegment || '/' || (c_custkey % 9)
  || '?a=' || (c_custkey % 3) || '&b=' || (c_custkey % 4) AS normalized_url FROM customer""",
    "host_counts": f"SELECT lower({_SITE}) AS host, count(*) AS n_pages FROM pages GROUP BY 1",
    # The rule lets any character but a line break stand second, so one digit and a blank pass.
    "valid_url": "SELECT c_custkey, c_custkey % 8 IN (0, 1) OR (c_custkey % 8 = 3 AND c_custkey < 10) AS is_valid FROM customer",
    "dedup_urls": f"""{_PLACED} SELECT p.id AS seq, normalized_url, CASE WHEN place = 1 THEN length(html)::INTEGER END AS n_chars,
  CASE WHEN place > 1 THEN 'Duplicate URL' END AS error FROM placed p JOIN src ON src.id = p.id""",
    "dedup_urls_drop": f"{_PLACED} SELECT id AS seq, normalized_url FROM placed WHERE place = 1",
    "skip_seen": f"""WITH {_TWINS} SELECT id AS seq, normalized_url FROM canon
  WHERE normalized_url NOT IN (SELECT normalized_url FROM canon WHERE id % 10 = 0)""",
    "drop_failed": f"{_PLACED} SELECT id AS seq, u AS url FROM placed WHERE place = 1",
    "fetch_outcome": """
WITH l AS (SELECT 'https://e.example/' || (user_id % 400) AS url, event_id, value AS elapsed_seconds,
    CASE event_id % 7 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 3 THEN 500 WHEN 4 THEN 413 WHEN 5 THEN 404 WHEN 6 THEN 200 END AS status FROM events),
a AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) - 1 AS attempt FROM l),
g AS (SELECT *, status IS NOT NULL AND status NOT IN (429, 500, 503) AS settles FROM a),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY url ORDER BY NOT settles, NOT settles AND attempt > 4, CASE WHEN settles THEN attempt ELSE -attempt END) = 1)
SELECT url, status::INTEGER AS status_code, CASE status WHEN 200 THEN 'body ' || event_id END AS content,
  CASE WHEN status IS NULL THEN 'TimeoutError: ' || event_id WHEN status = 200 THEN NULL
    WHEN status = 429 THEN 'HTTP 429: Too Many Requests (exceeded 4 retries)' WHEN status = 413 THEN 'HTTP 413: Payload Too Large'
    WHEN status >= 500 THEN 'HTTP ' || status || ' server error' ELSE 'HTTP status ' || status END AS error,
  elapsed_seconds, (attempt + 1)::INTEGER AS attempts, NOT settles AND attempt < 4 AS retryable FROM b""",
    "parse_date_formats": f"""
WITH o AS (SELECT o_orderkey, o_orderdate AS day, o_orderdate + to_seconds((o_orderkey % 86400)::BIGINT) AS moment FROM orders)
SELECT o_orderkey, {_PRINTED} AS published_date FROM o""",
    "relative_date": f"""
WITH e AS (SELECT event_id, ts, floor(value)::BIGINT AS n, [1, 1, 60, 60, 3600, 3600, 86400, 604800, 2592000, NULL][event_id % 10 + 1] AS unit FROM events)
SELECT event_id, strftime(ts - to_seconds(n * unit), {_ISO}) AS published_date FROM e""",
    "fresh_events": f"""
SELECT event_id, CASE event_id % 50 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false
  ELSE {_FRESH_AT} END AS is_fresh FROM events""",
    "freshness_summary": f"SELECT event_type, {_FRESH_AT} AS is_fresh, count(*) AS n_rows FROM events GROUP BY 1, 2",
    "html_title": f"SELECT page_id, {_tag('title')} AS title FROM pages",
    "html_h1": f"SELECT page_id, {_tag('h1')} AS h1 FROM pages",
    "html_links": """
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)
SELECT page_id, len(links) AS n_links, array_to_string(links, ' ') AS links FROM l""",
    "clean_text": f"SELECT page_id, trim(regexp_replace({_UNESCAPE.format(_CLEANED)}, ' +', ' ', 'g')) AS clean_text FROM pages",
    "extract_news": f"""
WITH o AS (SELECT *, strftime({_AS_OF} - to_hours((o_orderkey % 60)::BIGINT) + INTERVAL 30 MINUTES, {_ISO}) AS iso, o_orderkey % 5 AS v FROM orders)
SELECT o_orderkey AS seq, 'NEWS' AS "recordType", CASE WHEN v = 4 THEN 'Order ' || o_orderkey || ' & more'
    WHEN v = 3 THEN 'Order ' || o_orderkey || '& more' ELSE 'Order ' || o_orderkey || ' & more' END AS title,
  CASE WHEN v < 3 THEN 'About ' || o_orderpriority END AS content_summary,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Daily' ELSE 'AI News' END AS source_name, 'https://news.example/' || o_orderkey AS source_url,
  CASE WHEN v < 4 THEN iso END AS published_date, v < 4 AND o_orderkey % 60 BETWEEN 1 AND 24 AS is_fresh FROM o""",
    "extract_jobs": f"""
WITH p AS (SELECT *, p_partkey % 6 AS v, strftime({_AS_OF} - to_hours((p_partkey % 40)::BIGINT), {_ISO}) AS iso FROM part)
SELECT p_partkey AS seq, 'JOB' AS "recordType", CASE WHEN v = 5 THEN 'Unknown Company' ELSE p_brand END AS company_name,
  CASE WHEN v = 5 THEN 'Unknown Title' ELSE p_name END AS title, 'AI Jobs' AS source_name, 'https://jobs.example/' || p_partkey AS source_url,
  CASE WHEN v IN (0, 1, 2, 4) THEN iso END AS published_date, v IN (0, 1, 2, 4) AND p_partkey % 40 <= 24 AS is_fresh FROM p""",
    "extract_papers": f"""
SELECT k AS seq, 'RESEARCH_PAPER' AS "recordType", title, authors, paper_url, github_url, NULL::INTEGER AS github_stars, published_date
FROM ({_PAPER_RECORD})""",
    "json_ld_items": """
SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS n_items,
  CASE o_orderkey % 5 WHEN 1 THEN 1 ELSE 0 END::INTEGER AS last_script FROM orders WHERE o_orderkey % 5 IN (1, 2)""",
    "chunk_documents": _chunks(4000, 200) + "SELECT doc_id, chunk_no, chunk FROM n",
    "chunk_documents_sql": _chunks(4000, 200) + "SELECT doc_id, chunk_no, chunk FROM n",
    "sql_functions": f"""
WITH src AS (SELECT page_id AS id, url AS u FROM pages), {_CANON} SELECT p.page_id, c.normalized_url,
  regexp_full_match(p.url, 'https?://[^\\s/$.?#][^\\s]+') AS is_valid FROM canon c JOIN pages p ON p.page_id = c.id""",
    "read_pages": """
SELECT page_id AS seq, url, CASE WHEN page_id % 10 = 0 THEN 503 ELSE 200 END AS status_code,
  CASE WHEN page_id % 10 <> 0 THEN length(html) END::INTEGER AS n_chars, CASE WHEN page_id % 10 = 0 THEN 'HTTP 503 server error' END AS error,
  NULL::VARCHAR AS source_name FROM pages""",
    "read_lookups": "SELECT c_custkey, c_mktsegment AS canonical_name, 'alias' AS resolution_method FROM customer",
    "flatten_postings": """
WITH o AS (
  SELECT o_orderkey AS seq, 'Title ' || o_custkey AS title, o_orderpriority AS p, 'feed' AS source_name,
    CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'not a url' ELSE 'https://s.example/' || o_orderkey END AS source_url,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_date, o_orderkey % 2 = 0 AS is_fresh FROM orders)
SELECT seq, CASE seq % 10 WHEN 0 THEN 'OTHER' ELSE 'JOB' END AS record_type, p AS company_name, title, NULL::VARCHAR AS content_summary,
  source_name, source_url, published_date, is_fresh FROM o
UNION ALL
SELECT seq, CASE seq % 10 WHEN 0 THEN 'OTHER' ELSE 'NEWS' END, NULL, title, p, source_name, source_url, published_date, is_fresh FROM o""",
    "stream_freshness_summary": """
WITH e AS (
  SELECT *, floor(event_id * 3 / (SELECT max(event_id) + 1 FROM events)) AS batch, date_trunc('day', ts) AS d,
    floor(value) < 24 OR (floor(value) = 24 AND ts = date_trunc('second', ts)) AS fresh FROM events),
b AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) - INTERVAL 1 HOUR AS mark FROM e GROUP BY batch),
m AS (SELECT e.*, late.mark AS late FROM e LEFT JOIN b late ON late.batch = e.batch - 2)
SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n_rows, count(*) FILTER (WHERE fresh) AS n_fresh
FROM m WHERE (late IS NULL OR d + INTERVAL 1 DAY > late) AND d + INTERVAL 1 DAY <= (SELECT max(mark) FROM b) GROUP BY ALL""",
    "chunk_documents_small": _chunks(500, 60) + """
SELECT doc_id, count(*) AS n_chunks, sum(length(chunk))::BIGINT AS n_chars, max(length(chunk))::INTEGER AS longest FROM n GROUP BY doc_id""",
    "extraction_requests": _chunks(2000, 100) + """
SELECT E'Extract the names.\\nIMPORTANT: Return ONLY a valid JSON object matching the requested schema. Do NOT include markdown formatting or explanation. '
  || 'If information is missing in the provided source text, set the field value to null. Do NOT guess or fabricate data.' AS system_prompt,
  count(*) AS n_requests, count(DISTINCT doc_id) AS n_docs, max(length(chunk))::INTEGER AS longest FROM n""",
    "strip_title_prefix": "SELECT p_partkey, p_name || CASE p_partkey % 2 WHEN 0 THEN ' title: x' ELSE '' END AS title FROM part",
    "authors_codec": """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 2 THEN '' WHEN p_partkey % 3 = 0 THEN p_brand || ', ' || p_type
  ELSE p_name END AS authors FROM part""",
    "normalize_entity_name": "SELECT p_partkey, p_name AS norm FROM part",
    "resolve_entities": _RESOLVED,
    "resolve_fuzzy": f"SELECT p_partkey, canonical_name AS fuzzy_name, confidence FROM ({_RESOLVED}) WHERE resolution_method IN ('fuzzy', 'normalized')",
    "resolve_alias": """
SELECT 'nick ' || n_nationkey AS norm, n_name AS alias_name FROM nation
WHERE n_nationkey IN (SELECT p_partkey % 25 FROM part WHERE p_partkey % 6 = 0)""",
    "resolve_normalized": f"SELECT DISTINCT p_name AS norm, {_INITCAP} AS equal_name FROM part WHERE p_partkey % 6 = 1",
    "resolution_summary": f"""
SELECT resolution_method, count(*) AS n_names, avg(confidence) AS avg_confidence FROM ({_RESOLVED}) GROUP BY 1""",
    "review_queue": f"""
WITH s AS (SELECT DISTINCT p_name, {_INITCAP} AS shown, length(p_name) AS n FROM part WHERE p_partkey % 3 <> 1)
SELECT p_name || 'xqzvj' AS norm, shown AS fuzzy_name, round(2 * n / (2.0::DOUBLE * n + 5), 2) AS score FROM s
WHERE 2 * n / (2.0 * n + 5) >= 0.7 AND 2 * n / (2.0 * n + 5) < 0.85
UNION ALL SELECT DISTINCT 'zzqx' || (p_partkey % 7), NULL, NULL FROM part WHERE p_partkey % 3 = 1""",
    "github_owner_repo": """
SELECT c_custkey, CASE WHEN c_custkey % 6 < 3 THEN 'org' || (c_custkey % 50) END AS owner,
  CASE WHEN c_custkey % 6 < 3 THEN 'tool' || (c_custkey % 20) END AS repo FROM customer""",
    "github_url_clean": """
WITH p AS (SELECT p_partkey, replace(p_name, ' ', '-') AS n, CASE p_partkey % 3 WHEN 1 THEN '.git' WHEN 2 THEN 'git' ELSE '' END AS tail FROM part)
SELECT p_partkey, 'https://github.com/a/' || n || CASE WHEN tail = '.git' THEN '' ELSE tail END AS url,
  'https://github.com/a/' || rtrim(n || tail, '.git') AS url_compat FROM p""",
    "enrich_repo_stars": """
WITH r AS (SELECT s_suppkey % 50 AS o, s_suppkey % 20 AS t, max(CASE WHEN s_suppkey % 4 <> 3 THEN floor(s_acctbal) END)::INTEGER AS stars
  FROM supplier WHERE s_suppkey % 3 <> 2 GROUP BY 1, 2),
c AS (SELECT c_custkey, c_custkey % 6 AS v, c_custkey % 50 AS o, c_custkey % 20 AS t FROM customer)
SELECT c_custkey, CASE WHEN v < 3 THEN 'https://github.com/org' || c.o || '/tool' || c.t WHEN v = 3 THEN 'https://gitlab.com/org' || c.o || '/tool' END AS github_url,
  CASE WHEN v < 3 THEN stars END AS github_stars FROM c LEFT JOIN r ON c.o = r.o AND c.t = r.t""",
    "canonicalize_ref": """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS c FROM orders)
SELECT o_orderkey, CASE WHEN c % 3 = 1 AND c_name IS NOT NULL THEN c_name ELSE ' Customer ' || c END AS entity_name
FROM o LEFT JOIN customer ON c = c_custkey""",
    "validate_startups": f"SELECT s_suppkey AS seq, {_STARTUP_REASONS} AS reasons FROM supplier",
    "validate_products": f"SELECT p_partkey AS seq, {_PRODUCT_REASONS} AS reasons FROM part",
    "validate_papers": f"SELECT c_custkey AS seq, {_list(*_PAPER_RULES)} AS reasons FROM customer",
    "validate_jobs": f"SELECT o_orderkey AS seq, {_POSTING_REASONS} AS reasons FROM orders",
    "validate_news": f"SELECT o_orderkey AS seq, {_POSTING_REASONS} AS reasons FROM orders",
    "split_valid": f"""
SELECT CASE WHEN {_PRODUCT_REASONS} = '' THEN 'valid' ELSE 'rejected' END AS kind, count(*) AS n_rows, sum(p_partkey)::BIGINT AS sum_seq
FROM part GROUP BY 1""",
    "validation_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS n_rows FROM customer WHERE {bad}" for name, bad in _PAPER_RULES
    ),
    "check_constraints": """
SELECT s_suppkey AS seq, concat_ws(',', CASE WHEN s_suppkey % 7 = 1 THEN 'entity_name is null' END,
  CASE WHEN s_suppkey % 9 = 0 THEN 'source_url is null' END) AS reasons FROM supplier""",
    "duplicate_keys": "SELECT 'https://n.example/' || o_custkey AS source_url, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1",
    "union_records": f"""
SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 11 = 0 THEN 'NEWS' ELSE 'STARTUP' END AS record_type,
  CASE s_suppkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE s_name END AS entity_name, NULL AS startup_name,
  (s_suppkey % 5 - 1)::INTEGER AS employee_count, NULL AS pricing_model,
  CASE s_suppkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'not a url' ELSE 'https://s.example/' || s_suppkey END AS source_url FROM supplier
UNION ALL
SELECT p_partkey, 'PRODUCT', NULL, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE {_INITCAP} END, NULL, {_PRICE},
  CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'not a url' ELSE 'https://s.example/' || p_partkey END FROM part""",
    "upsert_papers": f"""
WITH s AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1),
s2 AS (SELECT k + 1 AS id, 'https://p.example/' || o_custkey AS paper_url, 'stored ' || k AS title, 'A, B' AS authors,
  CASE WHEN k % 8 = 0 THEN 'https://github.com/s/s' END AS github_url, 3 AS github_stars, '2020-01-01T00:00:00Z' AS published_date FROM s),
r AS ({_PAPER_DELTA}),
d AS (SELECT paper_url, min(seq) AS seq, arg_max(title, seq) FILTER (WHERE title <> '') AS title, arg_min_null(title, seq) AS title_1,
  arg_max(authors, seq) FILTER (WHERE authors <> '') AS authors, arg_max(github_url, seq) FILTER (WHERE github_url <> '') AS github_url,
  arg_max(github_stars, seq) FILTER (WHERE github_stars IS NOT NULL) AS github_stars,
  arg_max(published_date, seq) FILTER (WHERE published_date <> '') AS published_date FROM r GROUP BY paper_url)
SELECT s2.id, CASE WHEN s2.id IS NULL THEN d.seq END AS seq, coalesce(s2.paper_url, d.paper_url) AS paper_url,
  coalesce(d.title, CASE WHEN s2.id IS NULL THEN title_1 ELSE s2.title END) AS title, coalesce(d.authors, s2.authors, '') AS authors,
  coalesce(d.github_url, s2.github_url) AS github_url, coalesce(d.github_stars, s2.github_stars)::INTEGER AS github_stars,
  coalesce(d.published_date, s2.published_date) AS published_date
FROM s2 FULL JOIN d ON s2.paper_url = d.paper_url""",
    "upsert_jobs": _posting_oracle("JOB"),
    "upsert_news": _posting_oracle("NEWS"),
    "skip_seen_history": """
SELECT l_orderkey * 10 + l_linenumber AS seq, 'https://s.example/' || CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS normalized_url
FROM lineitem WHERE l_orderkey % 3 <> 0 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 5 < 2)""",
    "assign_ids": "SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey * 7 AS seq FROM orders",
    "append_startups": f"""
SELECT row_number() OVER (ORDER BY s_suppkey % 2, s_suppkey) AS id, s_name AS entity_name, (s_suppkey % 5 - 1)::INTEGER AS employee_count,
  'https://s.example/' || s_suppkey AS source_url FROM supplier WHERE {_STARTUP_REASONS} = ''""",
    "append_products": f"""
SELECT row_number() OVER (ORDER BY p_partkey) AS id, {_INITCAP} AS startup_name, {_PRICE} AS pricing_model,
  'https://s.example/' || p_partkey AS source_url FROM part WHERE {_PRODUCT_REASONS} = ''""",
    "append_entity_mappings": f"SELECT row_number() OVER (ORDER BY p_partkey) AS id, * EXCLUDE (p_partkey) FROM ({_RESOLVED})",
    "store_papers": f"""
SELECT row_number() OVER (ORDER BY k % 3 = 0, k) AS id, paper_url, title, github_url,
  CASE WHEN github_url IN (SELECT 'https://github.com/org' || (p_partkey % 40) || '/' || replace(p_name, ' ', '-') FROM part) THEN 7 END AS github_stars,
  published_date FROM ({_PAPER_RECORD})""",
    "lookup_by_url": """
WITH r AS (SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 't' || o_orderkey END AS title, o_orderpriority
  FROM orders WHERE o_orderkey % 3 = 0 OR o_custkey = 2)
SELECT 'https://n.example/2' AS source_url, arg_max(title, seq) FILTER (WHERE title IS NOT NULL) AS title, arg_min(o_orderpriority, seq) AS content_summary FROM r""",
    "run_summary": """
SELECT t AS table_name, n AS n_rows, CASE WHEN n > 0 THEN '2024-02-01' END AS last_day FROM (
  SELECT unnest(['sources', 'research_papers', 'startups', 'news', 'entity_mappings', 'crawl_jobs']) AS t, 0::BIGINT AS n
  UNION ALL SELECT 'products', count(*) FROM part
  UNION ALL SELECT 'jobs', count(DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE o_custkey END) FROM orders)""",
    "read_records": """
SELECT CASE WHEN p_partkey % 20 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n_rows FROM part GROUP BY 1""",
    "export_research_papers": f"""SELECT c_custkey AS id, '1.0' AS "schemaVersion", 'research_papers' AS "recordType", c_name AS title,
  CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ', ' || c_name WHEN 1 THEN c_name ELSE '' END AS authors,
  'https://p.example/' || c_custkey AS paper_url, NULL AS github_url, c_nationkey AS github_stars, '2024-01-01T00:00:00Z' AS published_date,
  {_STAMP} AS collected_at FROM customer""",
    "export_startups": _export("startups", f'c_name AS "entityName", {_SOURCE_COLUMNS}, c_nationkey AS "employeeCount", {_STAMP} AS "collectedAt"'),
    "export_products": _export(
        "products", f"""c_name AS "startupName", {_SOURCE_COLUMNS}, CASE c_custkey % 2 WHEN 0 THEN 'PAID' END AS "pricingModel", {_STAMP} AS "collectedAt\""""
    ),
    "export_jobs": _export("jobs", f'c_mktsegment AS "companyName", c_name AS title, {_SOURCE_COLUMNS}, {_DATED_COLUMNS}'),
    "export_news": _export("news", f'c_name AS title, {_QUOTED} AS "contentSummary", {_SOURCE_COLUMNS}, {_DATED_COLUMNS}'),
    "export_entity_mappings": _export(
        "entity_mappings", f"""c_name AS "rawName", upper(c_name) AS "canonicalName", 'STARTUP' AS "entityType", {_URL_S} AS "sourceUrl",
  'fuzzy' AS "resolutionMethod", 0.9::DOUBLE AS confidence, {_STAMP} AS "createdAt\""""
    ),
    "export_csv": f"""
SELECT c_custkey::VARCHAR AS id, c_name AS title, {_QUOTED} AS "contentSummary", '2024-01-01T00:00:00Z' AS "publishedDate",
  CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS "isFresh" FROM customer""",
    "merge_extractions": _ANSWERS + "SELECT request_id, name, provider, error FROM f",
    "collect_errors": _ANSWERS + "SELECT request_id, error FROM f WHERE error IS NOT NULL",
    "strip_code_fence": r"SELECT conv_id, turn, trim(text, E' \n\t\r') AS body FROM conversations",
    "parse_json_strict": """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'dict' WHEN 1 THEN 'list' END AS kind,
  CASE WHEN event_id % 5 = 0 THEN (props->>'$.k')::INTEGER END AS k FROM events""",
    "extract_with": """
WITH c AS (SELECT conv_id || '-' || turn AS request_id, length(text) AS n FROM conversations)
SELECT request_id, CASE WHEN n <= 300 OR n % 2 = 0 THEN n END::BIGINT AS n,
  CASE WHEN n <= 300 THEN 'short' WHEN n % 2 = 0 THEN 'long' END AS provider, n > 300 AND n % 2 = 1 AS failed FROM c""",
    "stream_dedup_urls": "SELECT DISTINCT 'https://e.example/' || user_id || '/' || event_type AS normalized_url FROM events",
    "stream_dedup_exact": """
SELECT min(event_id) AS seq, 'https://e.example/' || user_id || '/' || event_type AS normalized_url FROM events GROUP BY 2""",
    "stream_fresh_only": f"""
SELECT event_id, floor(value)::INTEGER || ' hours ago' AS published_date FROM events
WHERE floor(value) < 24 OR (floor(value) = 24 AND ts = date_trunc('second', ts))""",
    "stream_upsert": """
WITH d AS (SELECT o_custkey, min(o_orderkey) AS seq, arg_min(o_orderpriority, o_orderkey) AS content_summary,
  arg_max('t' || o_orderkey, o_orderkey) FILTER (WHERE o_orderkey % 5 <> 0) AS title, arg_max(o_orderkey % 2 = 0, o_orderkey) AS is_fresh
  FROM orders GROUP BY 1)
SELECT row_number() OVER (ORDER BY seq) AS id, 'https://n.example/' || o_custkey AS source_url, coalesce(title, 'Untitled') AS title,
  content_summary, is_fresh FROM d""",
    "upsert_rejected": """
SELECT 'news#' || (o_orderkey % 2) AS batch, 'source_url is null' AS reasons, o_orderkey AS seq,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 't' || o_orderkey END AS title
FROM orders WHERE o_orderkey % 7 = 0""",
    "site_titles": f"""
WITH src AS (SELECT page_id AS id, url AS u, html FROM pages), {_CANON},
f AS (SELECT min(id) AS id FROM canon GROUP BY normalized_url),
t AS (SELECT lower({_SITE.replace('url', 'u')}) AS host, nullif(CASE WHEN html LIKE '%<h1>%' THEN {_tag('h1')} ELSE {_tag('title')} END, '') AS title
  FROM src WHERE id IN (SELECT id FROM f))
SELECT host, count(*) AS n_pages, count(title) AS n_titled, max(length(title))::INTEGER AS longest_title FROM t GROUP BY host""",
}
