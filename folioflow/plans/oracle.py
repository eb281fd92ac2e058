"""The same results in plain SQL, for the check against another engine.

Cleaned markup has no SQL form; it is compared by its text and by counts of its tags.
"""

from __future__ import annotations

from folioflow import schemas as S
from folioflow.plans.queries import CUT_OFF, HOSTS, SEARCH_URL


def _clean(column: str) -> str:
    return rf"nullif(trim(regexp_replace({column}, '\s+', ' ', 'g')), '')"


_PATH = (
    r"regexp_replace(regexp_extract({0}, "
    r"'^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"
)


def _with_edges(table: str, number: str, every: int) -> str:
    return f"""
rows AS (
  SELECT *, unnest(CASE WHEN {number} % {every} = 0 THEN [false, true] ELSE [false] END) AS edge FROM {table})"""


def _path(url: str) -> str:
    return _PATH.format(url)


def _slug(url: str) -> str:
    name = f"regexp_extract({_path(url)}, '([^/]*)$', 1)"
    return rf"nullif(upper(trim(regexp_replace({name}, '\.[^.]*$', ''))), '')"


def _site(url: str) -> str:
    return f"regexp_extract({url}, '^([a-z]+://[^/?#]*)', 1)"


def _allowed(url: str) -> str:
    host = f"lower(regexp_extract({url}, '^[a-z]+://([^/?#:]*)', 1))"
    return "(" + " OR ".join(f"{host} = '{h}' OR suffix({host}, '.{h}')" for h in HOSTS) + ")"


def _case(number: str, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {whens} END"


def _extension(mime: str) -> str:
    whens = " ".join(f"WHEN '{m}' THEN '{e}'" for m, e in S.CONTENT_TYPE_EXTENSIONS.items())
    return f"CASE {mime} {whens} END"


def _decoded(markup: str) -> str:
    out = f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')"
    for name, char in (
        ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"),
        ("&amp;", "&"),
    ):
        out = f"replace({out}, '{name}', '{char}')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


_BODIES = """
b AS (SELECT page_id, regexp_extract(html, '(?s)<body[^>]*>(.*)$', 1) AS b FROM pages),
c AS (SELECT page_id, regexp_replace(b,
        '(?s)<nav>.*?</nav>|<footer>.*?</footer>|<script>.*?</script>|<style>.*?</style>',
        ' ', 'g') AS c FROM b)"""
_WITHOUT_COMMENTS = "regexp_replace(c, '(?s)<!--.*?-->', ' ', 'g')"


def _found(markup: str) -> str:
    return f"CAST(len(string_split(c, '{markup}')) - 1 AS INTEGER)"


_ARTICLE_TEXT = _decoded("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")

# URLs of these tables differ in their fragment only, where they name the same request.
_KEY = "split_part(url, '#', 1)"

_EVENTS = f"""
twice AS (
  SELECT *, unnest(CASE WHEN event_id % 7 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events),
ev AS (
  SELECT user_id || '-' || event_type AS identifier, event_id * 2 + copy AS seq,
         CASE copy WHEN 0 THEN sha256(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)) END AS file_hash,
         'events/' || user_id || '-' || event_type || '/' || event_id * 2 + copy AS object_key,
         CASE copy WHEN 0 THEN event_type END AS body, event_type,
         strftime(ts, '%Y-%m-%d') AS partition_date, ts, value, props
  FROM twice),
inc AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{CUT_OFF}'),
st AS (
  SELECT *, CASE WHEN seq % 10 <> 0 THEN object_key ELSE '' END AS path_to_file FROM ev
  WHERE ts < TIMESTAMP '{CUT_OFF}'
  QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1)"""


def _changes(incoming: str, state: str, tag: str = "") -> str:
    return f"""
joined{tag} AS (
  SELECT i.*, s.file_hash AS old_hash, s.path_to_file AS old_path,
         row_number() OVER (PARTITION BY i.identifier ORDER BY i.seq) AS rn,
         lag(i.file_hash) OVER (PARTITION BY i.identifier ORDER BY i.seq) AS prev
  FROM {incoming} i LEFT JOIN {state} s ON i.identifier = s.identifier),
marked{tag} AS (
  SELECT *, CASE WHEN rn = 1 THEN NOT coalesce(old_hash IS NOT DISTINCT FROM file_hash AND old_path <> '', false)
                 ELSE prev IS DISTINCT FROM file_hash END AS is_stored FROM joined{tag}),
changes{tag} AS (
  SELECT * EXCLUDE (is_stored), CASE WHEN is_stored THEN 'stored' ELSE 'unchanged' END AS scrape_status,
         coalesce(last_value(CASE WHEN is_stored THEN object_key END IGNORE NULLS) OVER (
           PARTITION BY identifier ORDER BY seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), old_path) AS path_to_file
  FROM marked{tag})"""


_CHANGE_COLUMNS = "SELECT identifier, seq, file_hash, scrape_status, path_to_file FROM changes"
_DETECT = f"WITH {_EVENTS}, {_changes('inc', 'st')} {_CHANGE_COLUMNS}"

_LANDED = f"""
{_EVENTS}, good AS (SELECT * FROM inc WHERE value >= 1), {_changes('good', 'st')},
landed AS (
  SELECT body, partition_date, scrape_status AS outcome FROM changes
  UNION ALL
  SELECT body, partition_date, CASE WHEN value < 0.5 THEN 'failed' ELSE 'dropped' END
  FROM inc WHERE value < 1)"""

_COUNTERS = """
  count(*) FILTER (outcome = 'stored') AS stored,
  count(*) FILTER (outcome = 'unchanged') AS unchanged,
  count(*) FILTER (outcome = 'failed') AS failed,
  count(*) FILTER (outcome IN ('failed', 'dropped')) AS dropped"""

_METRICS = f"""
{_LANDED},
tagged AS (
  SELECT body, left(partition_date, 7) AS partition_date, outcome, NULL AS value FROM landed
  UNION ALL SELECT body, left(partition_date, 7), NULL, value FROM ev),
summary AS (
  SELECT body, partition_date, {_COUNTERS}, count(value) AS pages_scraped,
         count(*) FILTER (value < 2 OR value >= 3) AS processed,
         count(*) FILTER (value >= 2 AND value < 3) AS transform_failed
  FROM tagged GROUP BY 1, 2)"""

_OUTCOMES = """
outcomes AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS identifier, d.lang AS body,
         CASE WHEN d.doc_id % 11 = 0 THEN 'skipped' WHEN l.doc_id IS NULL THEN 'failed'
              ELSE 'ok' END AS outcome,
         quality || ':' || toxic AS content
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_ORDERS = """
oc AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority AS body,
         strftime(o_orderdate, '%Y-%m') AS partition_date, CAST(o_orderdate AS DATE) AS d
  FROM orders),
grid AS (
  SELECT body, split_part(body, '-', 1) AS code, strftime(m, '%Y-%m') AS partition_date,
         CAST(m AS DATE) AS start_date, least(last_day(m), hi) AS end_date
  FROM (SELECT DISTINCT body FROM oc),
       (SELECT unnest(generate_series(date_trunc('month', min(d)), date_trunc('month', max(d)),
                                      INTERVAL 1 MONTH)) AS m, max(d) AS hi FROM oc))"""

_FIRST_BODY = list(S.BODIES)[0]
_BODY = _case("page_id", *[f"'{b}'" for b in S.BODIES])
_PAGE_CASES = f"""
pc AS (
  SELECT coalesce({_slug('url')}, 'Page ' || page_id) AS identifier, {_BODY} AS body,
         '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') AS partition_date,
         'Page ' || page_id AS title, page_id AS seq, sha256(html) AS file_hash,
         CASE WHEN page_id % 6 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
         CASE WHEN page_id % 6 = 0 THEN 'pdf' ELSE 'html' END AS ext
  FROM pages),
keyed AS (
  SELECT *, partition_date || '-01' AS record_date,
         'Source A/' || lower(replace(body, ' ', '_')) || '/' || partition_date || '/'
         || lower(identifier) || '.' || ext AS object_key FROM pc),
nothing AS (SELECT '' AS identifier, '' AS file_hash, '' AS path_to_file WHERE false),
{_changes('keyed', 'nothing')},
landing AS (
  SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1)"""

_RERUN = f"""
{_PAGE_CASES},
pc1 AS (
  SELECT coalesce({_slug('url')}, 'Page ' || page_id) AS identifier, {_BODY} AS body,
         CASE WHEN page_id % 4 = 2 THEN '2025-01'
              ELSE '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') END AS partition_date,
         'Page ' || page_id AS title, page_id AS seq, page_id,
         sha256(CASE WHEN page_id % 4 = 1 THEN html || ' v2' ELSE html END) AS file_hash,
         CASE WHEN page_id % 6 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
         CASE WHEN page_id % 6 = 0 THEN 'pdf' ELSE 'html' END AS ext
  FROM pages WHERE page_id % 4 <> 0),
keyed1 AS (
  SELECT *, 'Source A/' || lower(replace(body, ' ', '_')) || '/' || partition_date || '/'
         || lower(identifier) || '.' || ext AS object_key FROM pc1),
{_changes('keyed1', 'landing', '1')},
again AS (
  SELECT * FROM changes1 QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1),
final AS (
  SELECT identifier, body, partition_date, title, ext, path_to_file, file_hash, scrape_status,
         '2024-07-01' AS scraped_on FROM again
  UNION ALL
  SELECT identifier, body, partition_date, title, ext, path_to_file, file_hash, scrape_status, '2024-06-01'
  FROM landing WHERE identifier NOT IN (SELECT identifier FROM again)),
content AS (
  SELECT path_to_file, file_hash AS content_hash FROM (
    SELECT path_to_file, file_hash, 0 AS v, seq FROM changes WHERE scrape_status = 'stored' UNION ALL
    SELECT path_to_file, file_hash, 1, seq FROM changes1 WHERE scrape_status = 'stored')
  QUALIFY row_number() OVER (PARTITION BY path_to_file ORDER BY v DESC, seq DESC) = 1)"""

# The text that a landed payload has once it is cleaned; a suffix of the second batch stays in the text.
_TEXTS = f"""
{_BODIES},
texts AS (
  SELECT sha256(html) AS file_hash, sha256({_decoded(_WITHOUT_COMMENTS)}) AS text_hash
  FROM c JOIN pages USING (page_id)
  UNION
  SELECT sha256(html || ' v2'), sha256({_decoded(_WITHOUT_COMMENTS + " || ' v2'")})
  FROM c JOIN pages USING (page_id))"""

_PROCESSED_KEY = "replace(body, ' ', '_') || '/' || partition_date || '/' || identifier || '.' || ext"

_LINK = "CASE WHEN page_id % 3 = 0 THEN 'https://files.example.org/a+b%2Fcase%20' || page_id || '%2EPDF?x=1.doc' ELSE url END"

ORACLE = {
    "clean_text_cols": f"""
WITH {_with_edges('documents', 'doc_id', 5)},
r AS (SELECT doc_id, edge, CASE WHEN edge THEN {_case("doc_id", "' ' || chr(9) || chr(10) || ' '", "''", "NULL")}
             ELSE {_case("doc_id", "text", "'  ' || chr(9) || replace(text, ' ', ' ' || chr(10) || ' ') || chr(9)",
                         "chr(10) || text")} END AS raw FROM rows)
SELECT doc_id, edge, {_clean('raw')} AS cleaned,
       trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS collapsed FROM r""",
    "normalise_dates": f"""
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, {_case(
        "o_orderkey", "strftime(o_orderdate, '%d/%m/%Y')",
        "day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)",
        "strftime(o_orderdate, '%Y-%m-%d')", "'31/02/' || year(o_orderdate)",
        "strftime(o_orderdate, '%d.%m.%Y')")} AS raw FROM orders),
n AS (SELECT *, coalesce(strftime(try_strptime(raw, '%d/%m/%Y'), '%Y-%m-%d'),
                         strftime(try_strptime(raw, '%Y-%m-%d'), '%Y-%m-%d'), raw) AS record_date
      FROM r)
SELECT o_orderkey, raw, record_date,
       CAST(try_strptime(record_date, '%Y-%m-%d') AS DATE) AS record_day, d AS parsed FROM n""",
    "identifier_from_url": f"""
WITH {_with_edges('pages', 'page_id', 4)},
r AS (SELECT page_id, edge, CASE WHEN edge THEN '' ELSE url END AS url,
             {_case("page_id", "NULL", "CAST(page_id AS VARCHAR)", "'REF-' || page_id")} AS raw,
             'Title ' || page_id AS title FROM rows),
s AS (SELECT *, {_path('url')} AS path, {_slug('url')} AS slug FROM r)
SELECT page_id, edge, path, slug,
       CASE WHEN regexp_full_match(raw, '[0-9]+') AND slug IS NOT NULL THEN slug
            ELSE coalesce(raw, slug, title) END AS identifier FROM s""",
    "content_type_ext": f"""
WITH {_with_edges('pages', 'page_id', 3)},
r AS (SELECT page_id, edge, url AS link, {_case(
        "page_id", "'text/html'", "'application/pdf'", "''", "''", "'application/xhtml+xml'",
        "'application/vnd.ms-word.document.macroenabled.12'", "'text/plain'")} AS mime,
     {_case("page_id", "NULL", "'docx'", "NULL", "NULL")} AS name_suffix FROM rows),
s AS (SELECT *, CASE WHEN edge THEN '/a+b/case ' || page_id || '.PDF'
                     ELSE {_path('link')} END AS decoded_path FROM r),
t AS (SELECT *, nullif(lower(regexp_extract(regexp_extract(decoded_path, '([^/]*)/*$', 1),
                                            '^.+\\.([^.]+)$', 1)), '') AS suffix FROM s)
SELECT page_id, edge, mime, decoded_path, suffix,
       coalesce({_extension('mime')}, name_suffix, suffix,
                CASE WHEN contains(mime, 'html') THEN 'html' END, 'bin') AS landing_ext,
       coalesce({_extension('mime')}, 'bin') AS processed_ext,
       mime IN ('application/pdf', 'application/vnd.ms-word.document.macroenabled.12')
         OR (NOT edge AND regexp_matches(lower(decoded_path), '\\.(pdf|doc|docx)$'))
         AS is_binary FROM t""",
    "object_keys": f"""
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN source ELSE 'unknown' END AS source, lang,
                  lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') AS m,
                  {_case("doc_id", "'pdf'", "'html'", "'bin'")} AS ext FROM documents)
SELECT doc_id,
       source || '/court_of_' || lower(lang) || '/2024-' || m || '/case_' || doc_id || '-a.' || ext
         AS landing_key,
       'Court_of_' || upper(lang) || '/2024-' || m || '/Case/' || doc_id || '-A.' || ext
         AS processed_key FROM r""",
    "content_hash": """
WITH r AS (SELECT doc_id, text, 'https://docs.example.org/' || doc_id AS link FROM documents)
SELECT doc_id, sha256(CASE WHEN text = '' THEN 'x' ELSE text END) AS by_bytes,
       sha256(CASE WHEN text = '' THEN link ELSE text END) AS by_html, sha256(link) AS by_link,
       sha256(text || chr(65533) || 'z') AS decoded FROM r""",
    "page_charsets": r"""
SELECT 'https://docs.example.org/' || doc_id AS url, 'text/html' AS content_type,
       sha256('<main>x' || rtrim(regexp_replace(coalesce(text, ''), '[^0-9A-Za-z\x{A1}-\x{FF}]+', ' ', 'g') || '“€é”') || '</main>') AS markup
FROM documents""",
    "resolve_links": f"""
WITH r AS (SELECT page_id, url, {_site('url')} AS site,
                  regexp_replace({_path('url')}, '[^/]*$', '') AS folder FROM pages),
t AS (SELECT page_id, {_case(
        "page_id", "site || '/rooted/a.pdf'", "site || folder || 'sub/b.pdf?x=1'",
        "site || regexp_replace(folder, '[^/]*/$', '') || 'up/c.pdf'",
        "site || folder || 'd/f.pdf'",
        "regexp_extract(url, '^([a-z]+:)', 1) || '//other.example.net/g.pdf'",
        "'http://elsewhere.test/h.pdf'",
        "regexp_extract(url, '^([^?#]*)', 1) || '?page=2'")} AS target FROM r)
SELECT page_id, target, lower(regexp_extract(target, '^[a-z]+://([^/?#:]*)', 1)) AS host,
       {_allowed('target')} AS allowed FROM t""",
    "month_partitions": f"WITH {_ORDERS} SELECT DISTINCT partition_date, start_date, end_date FROM grid",
    "customer_months": """
WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
           FROM orders GROUP BY 1),
d AS (SELECT o_custkey, CASE WHEN o_custkey % 5 = 0 THEN hi ELSE lo END AS a,
             CASE WHEN o_custkey % 5 = 0 THEN lo ELSE hi END AS b FROM s),
m AS (SELECT *, unnest(generate_series(date_trunc('month', a), date_trunc('month', b),
                                       INTERVAL 1 MONTH)) AS m FROM d)
SELECT o_custkey, strftime(m, '%Y-%m') AS partition_date, CAST(m AS DATE) AS start_date,
       least(last_day(m), b) AS end_date FROM m""",
    "previous_month": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS month_key,
       strftime(o_orderdate, '%Y-%m') AS label, strftime(o_orderdate, '01/%m/%Y') AS first_day,
       strftime(last_day(o_orderdate), '%d/%m/%Y') AS last_day,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m-%d') AS previous_key
FROM orders""",
    "run_requests": """
WITH k AS (SELECT strftime(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH, '%Y-%m-%d') AS month_key
           FROM orders)
SELECT DISTINCT o_orderpriority AS body, month_key, month_key || '|' || o_orderpriority AS run_key
FROM orders, k""",
    "partition_grid": f"""
WITH {_ORDERS}
SELECT body, code, partition_date, start_date, end_date,
       '{SEARCH_URL}?decisions=1&from=' || strftime(start_date, '%d/%m/%Y') || '&to='
       || strftime(end_date, '%d/%m/%Y') || '&legislationsub=&body=' || code AS url
FROM grid WHERE body IN ('1-URGENT', '2-HIGH', '5-LOW')""",
    "body_counts": f"""
WITH r AS (SELECT {_case("doc_id", *[f"'{b}'" for b in S.BODIES], "'Other'")} AS body FROM documents)
SELECT body, CASE body {" ".join(f"WHEN '{b}' THEN '{c}'" for b, c in S.BODIES.items())} END AS code,
       count(*) AS n FROM r GROUP BY 1, 2""",
    "pending_partitions": f"""
WITH {_ORDERS}
SELECT DISTINCT body, partition_date, 'pending' AS state FROM oc a
WHERE NOT EXISTS (SELECT 1 FROM oc b WHERE b.body = a.body
                  AND b.partition_date = a.partition_date AND b.o_orderstatus = 'F')""",
    "ready_partitions": f"""
WITH {_ORDERS}
SELECT body, partition_date FROM grid g
WHERE EXISTS (SELECT 1 FROM oc WHERE oc.body = g.body AND oc.partition_date = g.partition_date
              AND oc.o_orderstatus = 'P')""",
    "month_range_scan": f"""
WITH {_ORDERS}
SELECT o_orderkey, body, partition_date FROM oc
WHERE partition_date BETWEEN '1996-02' AND '1997-07' AND body = '1-URGENT'""",
    "month_range_counts": f"""
WITH {_ORDERS}
SELECT body, count(*) AS n FROM oc WHERE partition_date BETWEEN '1996-02' AND '1997-07' GROUP BY 1""",
    "normalize_cases": f"""
WITH {_with_edges('documents', 'doc_id', 4)},
r AS (SELECT d.doc_id, edge, {_case("d.doc_id", "NULL", "CAST(d.doc_id AS VARCHAR)", "'REF ' || d.doc_id",
                                   "NULL", "CAST(d.doc_id AS VARCHAR)")} AS raw,
                  CASE WHEN NOT edge THEN {_clean('text')} END AS title,
                  {_case("d.doc_id", "'2024-03-07'", "'2024-03-09'", "'March 2024'", "NULL")} AS record_date,
                  source || ' A' AS source, 'Court of ' || lang AS body, CASE WHEN NOT edge THEN {_slug('url')} END AS slug
           FROM rows d LEFT JOIN pages p ON p.page_id = d.doc_id),
i AS (SELECT *, CASE WHEN regexp_full_match(raw, '[0-9]+') AND slug IS NOT NULL THEN slug
                     ELSE coalesce(raw, slug, title) END AS identifier FROM r)
SELECT doc_id, edge, identifier, title, CAST(NULL AS VARCHAR) AS description, 'REF ' || doc_id AS case_number,
       record_date, source, body, identifier IS NULL AS dropped FROM i""",
    "detect_changes": _DETECT,
    "stream_changes": _DETECT,
    "detect_changes_split": f"""
WITH {_EVENTS}, inc2 AS (SELECT * REPLACE (event_type AS identifier) FROM inc),
st2 AS (SELECT * REPLACE (event_type AS identifier) FROM st
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY seq DESC) = 1),
{_changes('inc2', 'st2')} {_CHANGE_COLUMNS}""",
    "upsert_latest": f"""
WITH {_EVENTS}, new AS (
  SELECT *, CASE WHEN seq % 3 <> 0 THEN object_key END AS path_to_file FROM inc
  QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1)
SELECT coalesce(n.identifier, s.identifier) AS identifier,
       CASE WHEN n.seq IS NOT NULL THEN n.seq ELSE s.seq END AS seq,
       CASE WHEN n.seq IS NOT NULL THEN n.value ELSE s.value END AS value, s.props AS props,
       CASE WHEN n.seq IS NOT NULL THEN n.path_to_file ELSE s.path_to_file END AS path_to_file
FROM st s FULL OUTER JOIN new n ON n.identifier = s.identifier""",
    "landing_counters": f"""
WITH {_LANDED}
SELECT body, partition_date, {_COUNTERS}, count(*) FILTER (outcome = 'failed') = 0 AS success
FROM landed GROUP BY 1, 2""",
    "content_join_outcomes": f"""
WITH {_OUTCOMES}
SELECT identifier, body, outcome,
       CASE WHEN outcome = 'ok' THEN body || '/2024-01/' || identifier || '.pdf' END AS path_to_file,
       CASE WHEN outcome = 'ok' THEN sha256(content) END AS file_hash FROM outcomes""",
    "transform_counters": f"""
WITH {_OUTCOMES}
SELECT body, count(*) FILTER (outcome <> 'failed') AS processed,
       count(*) FILTER (outcome = 'failed') AS failed,
       count(*) FILTER (outcome = 'failed') = 0 AS success FROM outcomes GROUP BY 1""",
    "key_collisions": """
WITH r AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN 'Ref/' ELSE 'ref_' END || doc_id // 2 AS identifier,
                  'S/b/2024-01/ref_' || doc_id // 2 || '.html' AS path_to_file FROM documents)
SELECT path_to_file, count(*) AS identifiers, min(identifier) AS first_identifier
FROM r GROUP BY 1 HAVING count(*) > 1""",
    "run_metrics": f"""
WITH {_METRICS}
SELECT body, partition_date, CAST(partition_date || '-01' AS DATE) AS start_date,
       last_day(CAST(partition_date || '-01' AS DATE)) AS end_date, stored, unchanged, failed, dropped,
       pages_scraped, processed, transform_failed, CAST(0 AS DOUBLE) AS elapsed_seconds
FROM summary""",
    "run_statistics": f"""
WITH {_METRICS}
SELECT body, partition_date || '-01' AS start_date, 0 AS return_code, stored, unchanged, failed, dropped,
       pages_scraped, CAST(0 AS DOUBLE) AS elapsed_seconds, true AS success, processed AS raw_processed
FROM summary""",
    "clean_pages": f"""
WITH {_BODIES},
t AS (SELECT page_id, {_decoded(_WITHOUT_COMMENTS)} AS body_text FROM c),
w AS (SELECT page_id, url, {_decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title FROM pages)
SELECT page_id, url, CAST(length(body_text) AS INTEGER) AS size, sha256(body_text) AS text_hash,
       sha256(body_text) AS bare_hash, false AS bare_page, true AS hashed, CAST(NULL AS VARCHAR) AS error
FROM t JOIN w USING (page_id)""",
    "clean_pages_markup": f"""
WITH {_BODIES}
SELECT page_id, true AS wrapped, 0 AS chrome, {_found('<p>')} AS paragraphs, {_found('<b>')} AS bold,
       {_found('<br>')} AS breaks, {_found('<h1>')} AS headings, {_found('<article>')} AS articles,
       {_found('<a ')} AS links, {_found('<!--')} AS comments FROM c""",
    "clean_pages_text": f"""
WITH {_BODIES}
SELECT page_id, {_decoded(_WITHOUT_COMMENTS)} AS cleaned_text FROM c""",
    "page_quality_gate": f"""
WITH t AS (SELECT page_id, CAST(CASE WHEN page_id % 3 = 0 THEN 0 ELSE length({_ARTICLE_TEXT}) END AS INTEGER)
             AS text_length FROM pages)
SELECT page_id, text_length, text_length >= 100 AS meaningful,
       CASE WHEN page_id % 5 = 4 THEN 'file' WHEN text_length >= 100 THEN 'html'
            ELSE 'html_fallback' END AS route FROM t""",
    "page_links": f"""
WITH r AS (SELECT page_id, url,
             replace(replace(regexp_extract(html, '<li><a href="([^"]*)"', 1), '&quot;', '"'), '&amp;', '&')
             || {_case("page_id", "NULL", "'.pdf'", "'.doc'", "'.docx'", "''", "''", "''", "'.pdf?x=1'")} AS attachment_href
           FROM pages),
t AS (SELECT *, {_site('url')} || attachment_href AS attachment_url FROM r)
SELECT page_id, attachment_href, attachment_url,
       CASE WHEN attachment_url IS NOT NULL THEN {_allowed('attachment_url')} END AS allowed FROM t""",
    "listings": """
SELECT doc_id // 10 AS page, 'Source A' AS source,
       CAST(row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) - 1 AS INTEGER) AS position,
       'REF-' || doc_id AS identifier, 'REF-' || doc_id AS case_number, nullif(text, '') AS title,
       source AS description,
       strftime(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER), '%Y-%m-%d') AS record_date,
       '/cases/' || doc_id AS source_page_url
FROM documents QUALIFY doc_id % 4 IN (0, 1)""",
    "listings_per_page": """
SELECT doc_id // 10 AS page, CAST(count(*) AS INTEGER) AS n_listings, CAST(NULL AS VARCHAR) AS error
FROM documents GROUP BY 1""",
    "first_requests": """
SELECT CASE WHEN doc_id % 3 = 0 THEN '/hot' ELSE '/d/' || doc_id // 2 END AS url, lang AS body,
       doc_id AS position FROM documents
QUALIFY row_number() OVER (PARTITION BY url ORDER BY body, position) = 1""",
    "crawl_chain": f"""
WITH RECURSIVE k AS (
  SELECT page_id, url, {_KEY} AS key, page_id // 16 AS block,
         CASE WHEN page_id % 16 < 15 THEN page_id + 1
              WHEN (page_id // 16) % 3 = 0 THEN page_id // 16 * 16
              WHEN (page_id // 16) % 3 = 1 THEN page_id + 8 END AS next_id FROM pages),
e AS (
  SELECT a.key AS src, a.url, b.key AS dst, b.url AS target FROM k a JOIN k b ON b.page_id = a.next_id
  QUALIFY row_number() OVER (PARTITION BY a.key ORDER BY a.url, b.url) = 1),
r AS (
  SELECT key, block, CAST(1 AS BIGINT) AS page FROM k WHERE page_id % 16 = 0
  UNION ALL
  SELECT e.dst, r.block, r.page + 1 FROM r JOIN e ON e.src = r.key
  WHERE r.page < 64),  -- a bound of this check alone: no chain here is longer, and loops must end
names AS (
  SELECT src AS key, url, 0 AS rank FROM e UNION ALL
  SELECT key, url, 1 FROM k WHERE page_id % 16 = 0 UNION ALL SELECT dst, target, 2 FROM e),
named AS (
  SELECT * FROM names QUALIFY row_number() OVER (PARTITION BY key ORDER BY rank, url) = 1),
one AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY key ORDER BY page, block) = 1)
SELECT named.url, block, page FROM one JOIN named USING (key)""",
    "attach_documents": f"""
WITH p AS (
  SELECT page_id, url, {_KEY} AS key,
         CASE WHEN length({_ARTICLE_TEXT}) >= 100 THEN 'html' ELSE 'html_fallback' END AS route FROM pages),
d AS (
  SELECT page_id, url AS document_url, first_value(url) OVER w AS final_url, first_value(route) OVER w AS route,
         row_number() OVER (PARTITION BY key ORDER BY page_id) AS asked FROM p
  WINDOW w AS (PARTITION BY key ORDER BY url))
SELECT page_id, document_url, final_url, route, CAST(NULL AS VARCHAR) AS file_hash FROM d WHERE asked = 1
UNION ALL
SELECT -page_id - 1, 'https://thin.example.org/' || page_id || '#x',
       CASE WHEN page_id % 10 = 0 THEN 'https://thin.example.org/file/' || page_id || '?a=1&b=2' END,
       CASE WHEN page_id % 10 = 0 THEN 'file' END, CASE WHEN page_id % 10 = 0 THEN sha256(html) END
FROM pages WHERE page_id % 5 = 0""",
    "landing_zone": f"""
WITH {_PAGE_CASES}
SELECT identifier, body, partition_date, record_date, title, content_type, path_to_file, file_hash,
       scrape_status FROM landing""",
    "processed_zone": f"""
WITH {_PAGE_CASES}, {_TEXTS}
SELECT identifier, body, partition_date, record_date, title, content_type,
       {_PROCESSED_KEY} AS path_to_file, scrape_status,
       CASE WHEN ext = 'pdf' THEN file_hash ELSE text_hash END AS digest
FROM landing LEFT JOIN texts USING (file_hash) WHERE partition_date BETWEEN '2024-02' AND '2024-11'""",
    "landing_rerun": f"""
WITH {_RERUN}
SELECT identifier, body, partition_date, title, path_to_file, file_hash, scrape_status, content_hash, scraped_on
FROM final LEFT JOIN content USING (path_to_file)""",
    "rerun_counters": f"""
WITH {_RERUN},
all_rows AS (
  SELECT body, partition_date, scrape_status AS outcome FROM changes1
  UNION ALL
  SELECT {_BODY}, '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0'),
         CASE WHEN page_id % 8 = 0 THEN 'failed' ELSE 'dropped' END FROM pages WHERE page_id % 4 = 0)
SELECT body, partition_date, {_COUNTERS}, count(*) FILTER (outcome = 'failed') = 0 AS success
FROM all_rows GROUP BY 1, 2""",
    "full_pipeline": f"""
WITH {_RERUN}, {_TEXTS},
runs AS (
  SELECT l.identifier, l.body, l.partition_date, l.ext, l.scrape_status, '2024-06-01' AS scraped_on, c.file_hash,
         '2024-06-01' AS processed_on, 0 AS run
  FROM landing l JOIN (SELECT path_to_file, max_by(file_hash, seq) AS file_hash FROM changes
                       WHERE scrape_status = 'stored' GROUP BY 1) c USING (path_to_file)
  WHERE partition_date BETWEEN '2024-01' AND '2024-12'
  UNION ALL
  SELECT identifier, body, partition_date, ext, scrape_status, scraped_on, content_hash, '2024-07-01', 1
  FROM final JOIN content USING (path_to_file) WHERE partition_date BETWEEN '2024-02' AND '2025-01'),
kept AS (
  SELECT * FROM runs WHERE body = '{_FIRST_BODY}'
  QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY run DESC) = 1)
SELECT identifier, body, partition_date, {_PROCESSED_KEY} AS path_to_file, scrape_status,
       CASE WHEN ext = 'pdf' THEN file_hash ELSE text_hash END AS digest, scraped_on, processed_on
FROM kept LEFT JOIN texts USING (file_hash)""",
    "full_pipeline_metrics": f"""
WITH {_RERUN},
tagged AS (
  SELECT 0 AS run, body, partition_date, scrape_status AS outcome, NULL AS done, NULL AS page FROM changes
  UNION ALL SELECT 1, body, partition_date, scrape_status, NULL, NULL FROM changes1
  UNION ALL SELECT 1, {_BODY}, '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0'),
                   CASE WHEN page_id % 8 = 0 THEN 'failed' ELSE 'dropped' END, NULL, NULL
            FROM pages WHERE page_id % 4 = 0
  UNION ALL SELECT 0, body, partition_date, NULL, 1, NULL FROM landing
            WHERE body = '{_FIRST_BODY}' AND partition_date BETWEEN '2024-01' AND '2024-12'
  UNION ALL SELECT 1, body, partition_date, NULL, 1, NULL FROM final
            WHERE body = '{_FIRST_BODY}' AND partition_date BETWEEN '2024-02' AND '2025-01'
  UNION ALL SELECT 1, {_BODY}, CASE WHEN page_id % 4 = 2 THEN '2025-01'
                   ELSE '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') END, NULL, NULL, 1 FROM pages)
SELECT CAST(run AS BIGINT) AS run, body, partition_date, CAST(partition_date || '-01' AS DATE) AS start_date,
       last_day(CAST(partition_date || '-01' AS DATE)) AS end_date, {_COUNTERS}, count(page) AS pages_scraped,
       count(done) AS processed, CAST(0 AS BIGINT) AS transform_failed, CAST(0 AS DOUBLE) AS elapsed_seconds
FROM tagged GROUP BY 1, 2, 3""",
    "capture_run": f"""
WITH p AS (
  SELECT page_id, url, first_value(url) OVER (PARTITION BY {_KEY} ORDER BY url) AS final_url,
         strftime(DATE '2012-01-01' + to_months(CAST(page_id // 40 AS INTEGER)), '%Y-%m') AS m FROM pages
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY page_id) = 1)
SELECT 'REF/' || page_id AS identifier, 'Labour Court' AS body, m AS partition_date,
       'Case ' || page_id AS title, url AS source_page_url, final_url AS link_to_doc,
       'text/html' AS content_type,
       'Source A/labour_court/' || m || '/ref_' || page_id || '.html' AS path_to_file,
       'stored' AS scrape_status FROM p""",
    "stream_landing": f"""
WITH {_EVENTS}, none AS (SELECT '' AS identifier, '' AS file_hash, '' AS path_to_file WHERE false),
one AS (SELECT * FROM ev WHERE seq % 2 = 0), {_changes('one', 'none')}
SELECT identifier, body, CAST(seq // 2 AS VARCHAR) AS case_number, strftime(ts, '%Y-%m-%d') AS record_date,
       strftime(ts, '%Y-%m') AS partition_date, file_hash, scrape_status,
       'Events/' || body || '/' || strftime(ts, '%Y-%m') || '/' || lower(identifier) || '.html'
         AS path_to_file
FROM changes QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1""",
}

# The whole runs over all bodies: the same without the body.
ORACLE |= {
    "full_pipeline_bodies": ORACLE["full_pipeline"].replace(f" WHERE body = '{_FIRST_BODY}'", ""),
    "full_pipeline_bodies_metrics": ORACLE["full_pipeline_metrics"].replace(f"body = '{_FIRST_BODY}' AND ", ""),
}

_MONTH = "'2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0')"
_HOT = "CASE WHEN seq % 3 = 0 THEN 'hot' ELSE identifier END"


def _entities(words: str) -> str:
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        words = f"replace({words}, '{name}', '{char}')"
    return words


def _article_found(markup: str) -> str:
    return f"CAST(len(string_split(a, '{markup}')) - 1 AS INTEGER)"


def _given(field: str, value: str) -> str:
    mine = f"list_contains(mask, '{field}')"
    return (
        f"max_by({{'v': {value}}}, seq) FILTER ({mine}).v AS {field}, count(*) FILTER ({mine}) > 0 AS {field}_given"
    )


_FIELDS = ["body", "partition_date", "title", "description", "case_number"]

ORACLE |= {
    "content_markup": f"""
WITH r AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
t AS (SELECT *, regexp_replace(regexp_replace(a, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g') AS w FROM r)
SELECT page_id, true AS whole, {_article_found('<p>')} AS paragraphs, {_article_found('<b>')} AS bold,
       {_article_found('<br>')} AS breaks, {_article_found('<h1>')} AS headings, {_article_found('<a ')} AS links,
       {_article_found('<!--')} AS comments,
       CAST(len(regexp_extract_all(a, '<(script|style|form|div|ul|li)[ >]')) AS INTEGER) AS others,
       sha256(trim(regexp_replace({_entities('w')}, '\\s+', ' ', 'g'))) AS words_hash FROM t""",
    "page_isolation": f"""
WITH r AS (SELECT {_BODY} AS body, {_MONTH} AS partition_date,
                  page_id % 7 = 3 AND page_id % 6 <> 0 AS bad FROM pages)
SELECT body, partition_date, count(*) FILTER (NOT bad) AS stored, CAST(0 AS BIGINT) AS unchanged,
       count(*) FILTER (bad) AS failed, count(*) FILTER (bad) AS dropped, count(*) FILTER (bad) = 0 AS success,
       count(*) FILTER (bad) AS undecodable, count(*) FILTER (NOT bad) AS held FROM r GROUP BY 1, 2""",
    "stream_changes_hot": f"""
WITH {_EVENTS},
inc2 AS (SELECT * REPLACE ({_HOT} AS identifier) FROM inc),
st2 AS (SELECT * REPLACE ({_HOT} AS identifier) FROM st
        QUALIFY row_number() OVER (PARTITION BY {_HOT} ORDER BY seq DESC) = 1),
{_changes('inc2', 'st2')} {_CHANGE_COLUMNS}""",
    "field_writes": f"""
WITH {_EVENTS},
f AS (SELECT identifier, seq, ts, body, left(partition_date, 7) AS partition_date,
             CAST(round(value, 2) AS VARCHAR) AS title,
             CASE WHEN seq % 4 <> 0 THEN props END AS description, CAST(seq AS VARCHAR) AS case_number FROM ev),
o AS (SELECT * FROM f WHERE ts < TIMESTAMP '{CUT_OFF}' QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY seq DESC) = 1),
m AS (SELECT *, CASE seq % 5 WHEN 0 THEN ['title', 'description'] WHEN 1 THEN ['description']
                             WHEN 2 THEN ['body', 'partition_date', 'case_number'] WHEN 3 THEN ['title'] END AS mask
      FROM f WHERE ts >= TIMESTAMP '{CUT_OFF}'),
n AS (SELECT identifier, {', '.join(_given(c, "CASE WHEN seq % 3 <> 0 THEN title END" if c == "title" else c) for c in _FIELDS)} FROM m GROUP BY 1)
SELECT identifier, {', '.join(f"CASE WHEN n.{c}_given THEN n.{c} ELSE o.{c} END AS {c}" for c in _FIELDS)}
FROM o FULL OUTER JOIN n USING (identifier)""",
    "unreferenced_content": f"""
WITH {_RERUN},
written AS (
  SELECT DISTINCT path_to_file, CAST(0 AS BIGINT) AS batch FROM changes WHERE scrape_status = 'stored' UNION ALL
  SELECT DISTINCT path_to_file, CAST(1 AS BIGINT) FROM changes1 WHERE scrape_status = 'stored'),
judged AS (
  SELECT path_to_file, batch, batch < max(batch) OVER (PARTITION BY path_to_file) AS replaced,
         path_to_file IN (SELECT path_to_file FROM final WHERE title <> 'Page 7') AS used FROM written)
SELECT path_to_file, batch, CASE WHEN replaced THEN 'replaced' ELSE 'no row' END AS reason FROM judged WHERE replaced OR NOT used""",
}
ORACLE["full_pipeline_totals"] = f"""
SELECT body, partition_date, start_date, end_date, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in
  ('stored', 'unchanged', 'failed', 'dropped', 'pages_scraped', 'processed', 'transform_failed'))},
  sum(elapsed_seconds) AS elapsed_seconds, count(DISTINCT run) AS runs
FROM ({ORACLE["full_pipeline_bodies_metrics"]}) GROUP BY 1, 2, 3, 4"""
ORACLE["same_requests"] = """
WITH r AS (SELECT page_id, unnest([0, 3]) AS spelling, CAST(page_id AS VARCHAR) AS n FROM pages)
SELECT page_id, CAST(spelling AS INTEGER) AS spelling,
       'https://cases.example.org/' || CASE spelling WHEN 0 THEN 'doc' ELSE 'DOC' END || '/' || n
       || '~x%20%C3%A9?b=2&a=' || n || '&a-b=3&a=1' AS url,
       'https://cases.example.org/' || CASE spelling WHEN 0 THEN 'doc' ELSE 'DOC' END || '/' || n
       || '~x%20%C3%A9?a=' || least(n, '1') || '&a=' || greatest(n, '1') || '&a-b=3&b=2' AS request FROM r"""
