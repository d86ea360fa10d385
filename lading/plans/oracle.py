"""DuckDB SQL equal in result to each registered query (same column names
and types).  Queries without an entry here have no SQL form (checksums DuckDB
does not compute)."""

from __future__ import annotations

_LI_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_LI_RN = f"row_number() OVER (PARTITION BY l_returnflag ORDER BY {_LI_ORDER})"
_OFFSET = "CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 100 ELSE 1000000000 END AS BIGINT)"
_INT_AFF = """CASE WHEN regexp_matches({t}, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(trim({t}) AS BIGINT)
     WHEN regexp_matches({t}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') THEN
       CASE WHEN abs(TRY_CAST(trim({t}) AS DOUBLE)) < 9007199254740992
             AND TRY_CAST(trim({t}) AS DOUBLE) = floor(TRY_CAST(trim({t}) AS DOUBLE))
            THEN CAST(TRY_CAST(trim({t}) AS DOUBLE) AS BIGINT) END END"""
_REAL_AFF = """CASE WHEN regexp_matches({t}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
     THEN TRY_CAST(trim({t}) AS DOUBLE) END"""

_EVENTS_OLD_NEW = """
h AS (SELECT max(event_id) / 2 AS m FROM events),
old AS (
  SELECT user_id, event_type, event_id, value FROM events, h WHERE event_id <= m
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)"""

_NATION_VERSIONS = """
WITH r AS (
  SELECT n_name AS provider,
         CASE WHEN n_regionkey = 4 THEN '' ELSE 'v' || CAST(n_regionkey AS VARCHAR) END AS remote_version
  FROM nation),
s AS (
  SELECT n_name AS p,
         CASE WHEN n_nationkey % 2 = 0 THEN 'v' || CAST(n_regionkey AS VARCHAR)
              ELSE 'v' || CAST(n_regionkey + 1 AS VARCHAR) END AS etag
  FROM nation WHERE n_regionkey <> 0),
v AS (
  SELECT provider, coalesce(s.etag, '') AS stored_version, remote_version,
         (coalesce(s.etag, '') <> remote_version AND remote_version <> '') AS changed
  FROM r LEFT JOIN s ON s.p = r.provider)"""

ORACLE = {
    "provider_active_urls": """
SELECT s_name AS provider,
       'https://feeds.example.org/gtfs-static/' || 'nation-' || CAST(s_nationkey AS VARCHAR) AS url,
       'db-' || CAST(s_suppkey AS VARCHAR) AS database_id
FROM supplier WHERE s_acctbal > 0 AND s_nationkey % 5 <> 0""",
    "archive_expand": """
SELECT 'nation.txt' AS file,
       CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) AS line
FROM nation
UNION ALL
SELECT 'region.txt' AS file, CAST(r_regionkey AS VARCHAR) || ',' || r_name AS line FROM region""",
    "entry_filter": """
WITH b AS (SELECT page_id, split_part(url, '/', 4) || '_' || CAST(page_id AS VARCHAR) AS b FROM pages),
e AS (
  SELECT page_id,
         CASE page_id % 5 WHEN 0 THEN b || '.txt' WHEN 1 THEN '__MACOSX/' || b || '.txt'
              WHEN 2 THEN 'dir/._' || b || '.txt' WHEN 3 THEN 'dir/' || b || '.txt'
              ELSE b || '.TXT' END AS entry
  FROM b),
k AS (
  SELECT page_id, entry,
         (ends_with(entry, '.txt') AND NOT contains(entry, '__MACOSX')
          AND NOT starts_with(regexp_extract(entry, '[^/]*$'), '._')) AS keep
  FROM e)
SELECT page_id, entry, keep,
       CASE WHEN keep THEN regexp_replace(entry, '\\.txt$', '') END AS table_name
FROM k""",
    "entry_registry_join": """
SELECT event_id, event_type || '.txt' AS file, event_type AS table_name, r.n_columns
FROM events JOIN (VALUES ('click', 2), ('view', 1)) AS r(t, n_columns) ON events.event_type = r.t""",
    "csv_project_by_header": """
SELECT 'tpch' AS provider, o_orderpriority || '.txt' AS file, CAST(o_orderkey + 1 AS BIGINT) AS line_no,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) END AS o_totalprice,
       o_orderpriority
FROM orders""",
    "csv_drop_malformed": """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS DOUBLE) AS o_totalprice,
       o_orderpriority
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "csv_empty_is_string": """
SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN '' ELSE c_mktsegment END AS c_mktsegment
FROM customer""",
    "no_match_skip": """
SELECT r_name || '.txt' AS file,
       CASE WHEN r_name LIKE 'A%' THEN 0 ELSE 2 END AS n_matched,
       0 AS status,
       CAST(CASE WHEN r_name LIKE 'A%' THEN 0 ELSE 1 END AS BIGINT) AS rows_loaded
FROM region""",
    "numeric_affinity": f"""
WITH t AS (
  SELECT p_partkey,
         CASE p_partkey % 8
              WHEN 0 THEN CAST(p_size AS VARCHAR)
              WHEN 1 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
              WHEN 2 THEN '00' || CAST(p_size AS VARCHAR)
              WHEN 3 THEN CAST(p_size AS VARCHAR) || '.0'
              WHEN 4 THEN CAST(p_size AS VARCHAR) || 'e0'
              WHEN 5 THEN '+' || CAST(p_size AS VARCHAR)
              WHEN 6 THEN CAST(p_size AS VARCHAR) || '.5'
              ELSE 'x' || CAST(p_size AS VARCHAR) END AS size_text,
         CASE p_partkey % 4
              WHEN 0 THEN CAST(CAST(p_retailprice AS DECIMAL(8, 2)) AS VARCHAR)
              WHEN 1 THEN ' ' || CAST(CAST(p_retailprice AS DECIMAL(8, 2)) AS VARCHAR)
              WHEN 2 THEN 'nan'
              ELSE '' END AS price_text
  FROM part),
v AS (
  SELECT p_partkey, size_text, {_INT_AFF.format(t="size_text")} AS size_value,
         price_text, {_REAL_AFF.format(t="price_text")} AS price_value
  FROM t)
SELECT p_partkey, size_text, size_value, price_text, price_value,
       CAST((CASE WHEN trim(size_text) <> '' AND size_value IS NULL THEN 1 ELSE 0 END)
          + (CASE WHEN trim(price_text) <> '' AND price_value IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS n_rejects
FROM v""",
    "json_batch_explode": """
SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS batch_no, o_orderkey, o_custkey, o_orderstatus, o_orderpriority
FROM orders""",
    "line_numbers": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY {_LI_ORDER}) AS line_no
FROM lineitem""",
    "microbatch_number": f"""
WITH r AS (SELECT l_returnflag, {_LI_RN} AS rn FROM lineitem)
SELECT l_returnflag AS file, CAST(floor((rn - 1) / 500) AS BIGINT) AS batch_no,
       count(*) AS batch_rows, min(rn) AS first_line, max(rn) AS last_line
FROM r GROUP BY 1, 2""",
    "resume_offset": f"""
WITH r AS (SELECT l_returnflag, {_LI_ORDER}, {_LI_RN} AS rn FROM lineitem)
SELECT l_returnflag AS file, rn AS line_no, {_LI_ORDER}
FROM r WHERE rn > {_OFFSET}""",
    "row_budget": f"""
WITH f AS (SELECT l_returnflag AS file, {_OFFSET} AS resume_from, count(*) AS total
           FROM lineitem GROUP BY 1, 2),
g AS (SELECT file, resume_from, CAST(greatest(total - resume_from, 0) AS BIGINT) AS rows FROM f),
h AS (SELECT *, CAST(least(coalesce(sum(rows) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND 1 PRECEDING), 0), 25000) AS BIGINT) AS taken_before
      FROM g),
q AS (SELECT *, CAST(least(rows, greatest(25000 - taken_before, 0)) AS BIGINT) AS quota FROM h)
SELECT file, resume_from, rows, taken_before, quota, quota >= rows AS file_done,
       CAST(resume_from + quota AS BIGINT) AS last_line
FROM q""",
    "version_change_detect": _NATION_VERSIONS + """
SELECT provider, stored_version, remote_version, changed FROM v""",
    "provider_gate": _NATION_VERSIONS + """,
p AS (
  SELECT n_name AS provider,
         CASE WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal > 9000 THEN NULL ELSE 0 END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
c AS (SELECT provider, count(*) FILTER (WHERE status <> 0) AS incomplete FROM p GROUP BY 1)
SELECT v.provider, changed, CAST(coalesce(incomplete, 0) AS BIGINT) AS incomplete,
       CASE WHEN changed THEN 'import' WHEN coalesce(incomplete, 0) > 0 THEN 'resume' ELSE 'skip' END AS action
FROM v LEFT JOIN c ON c.provider = v.provider""",
    "resume_plan": """
WITH e AS (SELECT source AS provider, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS file, md5(text) AS crc
           FROM documents),
p AS (
  SELECT source AS provider, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS file,
         CASE WHEN lang = 'fr' THEN md5(text || 'x') ELSE md5(text) END AS s_crc,
         CAST(CASE WHEN lang = 'fr' THEN 5 ELSE n_chars % 1000 END AS BIGINT) AS s_line,
         CAST(CASE WHEN lang IN ('fr', 'de') THEN 0 WHEN n_chars % 2 = 0 THEN 1 ELSE NULL END AS INTEGER) AS s_status
  FROM documents WHERE lang <> 'en'),
j AS (
  SELECT e.provider, e.file,
         CASE WHEN p.file IS NULL THEN 'new'
              WHEN p.s_crc <> e.crc THEN 'restart'
              WHEN coalesce(p.s_status, -1) = 0 THEN 'skip'
              ELSE 'resume' END AS action,
         s_line
  FROM e LEFT JOIN p ON p.provider = e.provider AND p.file = e.file)
SELECT provider, file, action,
       CAST(CASE WHEN action IN ('new', 'restart') THEN 0
                 WHEN action = 'resume' THEN coalesce(s_line, 0) END AS BIGINT) AS "offset"
FROM j""",
    "incomplete_count": """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS provider,
       count(*) FILTER (WHERE CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE NULL END <> 0) AS incomplete
FROM orders GROUP BY 1""",
    "run_metrics": """
WITH r AS (
  SELECT 'u' || CAST(user_id // 50 AS VARCHAR) AS provider, event_type || '.txt' AS file,
         event_id AS line_no, (event_type = 'error' AND value > 50) AS error
  FROM events),
f AS (SELECT provider, file, count(*) AS rows, max(line_no) AS last_line, bool_or(error) AS file_error
      FROM r GROUP BY 1, 2)
SELECT provider, file, rows, last_line, file_error,
       CAST(sum(rows) OVER (PARTITION BY provider) AS BIGINT) AS provider_rows,
       bool_or(file_error) OVER (PARTITION BY provider) AS provider_error
FROM f""",
    "upsert_last_wins": """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "upsert_missing_null": """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) ELSE c_name END AS c_name,
       c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer""",
    "upsert_null_keys": "WITH" + _EVENTS_OLD_NEW + """,
new AS (
  SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS user_id, event_type, event_id, value
  FROM events, h WHERE event_id > m),
newk AS (
  SELECT * FROM new WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
SELECT * FROM old
WHERE NOT EXISTS (SELECT 1 FROM newk WHERE newk.user_id = old.user_id AND newk.event_type = old.event_type)
UNION ALL SELECT * FROM newk
UNION ALL SELECT * FROM new WHERE user_id IS NULL""",
    "upsert_keyless": """
SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region""",
    "version_upsert": """
SELECT n_name AS Provider,
       CASE WHEN n_regionkey IN (1, 2) THEN 'e2-' || CAST(n_nationkey AS VARCHAR)
            ELSE 'e1-' || CAST(n_regionkey AS VARCHAR) END AS ETag
FROM nation""",
    "progress_lifecycle": """
SELECT source AS Provider, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS FileName, md5(text) AS CRC,
       n_chars AS LastProcessedLine,
       CAST(CASE WHEN n_chars < 5000 THEN 0 ELSE 1 END AS INTEGER) AS Status
FROM documents WHERE lang <> 'de'""",
    "progress_rollback": f"""
WITH r AS (SELECT l_returnflag AS file, {_LI_RN} AS rn FROM lineitem),
b AS (SELECT file, CAST(floor((rn - 1) / 500) AS BIGINT) AS batch_no, max(rn) AS last_line, count(*) AS size
      FROM r GROUP BY 1, 2)
SELECT file,
       CAST(coalesce(min(CASE WHEN batch_no % 7 = 3 THEN greatest(last_line - size, 0) END),
                     max(last_line)) AS BIGINT) AS LastProcessedLine,
       CAST(CASE WHEN count(*) FILTER (WHERE batch_no % 7 = 3) > 0 THEN 1 ELSE 0 END AS INTEGER) AS Status
FROM b GROUP BY 1""",
    "status_json": """
SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS FileName,
       'DB_SRC3' AS binding,
       to_json(struct_pack(Provider := source,
                           FileName := 'doc_' || CAST(doc_id AS VARCHAR) || '.txt',
                           CRC := substr(md5(text), 1, 8),
                           LastProcessedLine := n_chars,
                           Status := CAST(CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS INTEGER)))::VARCHAR AS json
FROM documents WHERE source = 'src3'""",
    "schema_drift_report": """
WITH hdr AS (
  SELECT table_name AS t, list(column_name ORDER BY ordinal_position) AS cols
  FROM information_schema.columns
  WHERE table_name IN ('customer', 'orders', 'part', 'supplier', 'region', 'nation')
  GROUP BY table_name),
decl(t, dcols) AS (VALUES
  ('customer', ['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']),
  ('orders', ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice']),
  ('part', ['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice', 'p_comment']),
  ('supplier', ['s_name', 's_suppkey', 's_nationkey', 's_acctbal']),
  ('region', ['r_regionkey', 'r_comment']),
  ('lineitem', ['l_orderkey', 'l_linenumber'])),
j AS (
  SELECT coalesce(h.t, d.t) AS tbl, h.t AS ht, h.cols, d.dcols,
         list_filter(h.cols, lambda x: NOT list_contains(d.dcols, x)) AS miss,
         list_filter(d.dcols, lambda x: NOT list_contains(h.cols, x)) AS extra
  FROM hdr h FULL OUTER JOIN decl d ON h.t = d.t)
SELECT provider, tbl AS "table",
       CASE WHEN ht IS NOT NULL THEN ht || '.txt' END AS file,
       CASE WHEN dcols IS NULL THEN 'file_not_in_schema'
            WHEN ht IS NULL THEN 'table_without_file'
            WHEN cols = dcols THEN 'exact_match'
            WHEN len(miss) > 0 AND len(extra) > 0 THEN 'missing_and_extra'
            WHEN len(miss) > 0 THEN 'missing_in_db'
            WHEN len(extra) > 0 THEN 'extra_in_db'
            ELSE 'order_mismatch' END AS outcome,
       CASE WHEN ht IS NOT NULL AND dcols IS NOT NULL
            THEN array_to_string(list_sort(list_distinct(miss)), ',') END AS missing_in_db,
       CASE WHEN ht IS NOT NULL AND dcols IS NOT NULL
            THEN array_to_string(list_sort(list_distinct(extra)), ',') END AS extra_in_db,
       -- the customer feed header is written with a BOM, spaces and capitals
       CASE WHEN ht IS NOT NULL AND dcols IS NOT NULL
            THEN (ht <> 'customer' AND cols = dcols) END AS importer_exact
FROM j CROSS JOIN (VALUES ('tpch0'), ('tpch1')) p(provider)""",
    "entry_crc_check": """
SELECT 'li' || (l_orderkey % 4) AS provider, 'lineitem.txt' AS file, count(*) AS records,
       CAST(sum(strlen(concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus)) + 1)
            + strlen('l_orderkey,l_partkey,l_suppkey,l_linenumber,l_returnflag,l_linestatus') + 1 AS BIGINT) AS bytes,
       count(*) > 0 AS crc_matches
FROM lineitem GROUP BY 1""",
    "import_isolates_failures": """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
       'ord' || (o_orderkey % 4) AS provider, 0 AS status
FROM orders WHERE o_orderkey % 4 <> 1
UNION ALL SELECT NULL, NULL, 'orders.txt', 'ord1', 1""",
    "stream_isolates_failures": """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
       'ord' || (o_orderkey % 4) AS provider, CAST(0 AS BIGINT) AS attempts
FROM orders WHERE o_orderkey % 4 <> 3
UNION ALL SELECT NULL, NULL, 'orders.txt', 'ord3', CAST(2 AS BIGINT)""",
    "csv_quote_rules": """
SELECT o_orderkey,
       CASE o_orderkey % 4
            WHEN 0 THEN o_orderpriority || 'tail"' || o_orderstatus
            WHEN 1 THEN 'a,' || o_orderstatus || chr(13) || chr(10) || '"' || o_orderpriority
            WHEN 2 THEN o_orderstatus || '"x"'
            ELSE '' END AS a,
       o_custkey
FROM orders""",
    "scalar_names": """
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages),
s AS (SELECT page_id, path, string_split(trim(path, '/'), '/') AS seg FROM p)
SELECT page_id, path, seg[1] AS seg1, seg[2] AS seg2,
       'DB_' || upper(replace(seg[1], '-', '_')) AS binding,
       coalesce(seg[2], '') = 'status' AS is_status
FROM s""",
    "stream_available_now": """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "stream_feed_import": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "feed_import": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
}
