"""The same queries as SQL for DuckDB, written apart from the library."""

from __future__ import annotations

from tidemark.workload import inputs
from tidemark.workload.queries import ADHOC

E, O, L = inputs.EVENTS_SYNCED, inputs.ORDERS_SYNCED, inputs.LINES_SYNCED

# Columns of the given tables in order, with Spark's type names.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
SCHEMAS = {t: [tuple(c.split(" ")) for c in cols.split(", ")] for t, cols in COLUMNS.items()}

ISO = (
    "strftime({0}, '%Y-%m-%dT%H:%M:%S') || "
    "CASE WHEN date_part('microsecond', {0}) % 1000000 <> 0 THEN strftime({0}, '.%f') ELSE '' END"
)


def iso(column: str) -> str:
    return "(" + ISO.format(column) + ")"


def cut(text: str) -> str:
    return f"CASE WHEN length({text}) > 10000 THEN substr({text}, 1, 10000) || '...[TRUNCATED]' ELSE {text} END"


COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows" for t in SCHEMAS)

ODD_COUNTS = """
SELECT 'a b' AS "{0}", (SELECT count(*) FROM customer) AS rows, false AS failed
UNION ALL SELECT 'p%q', (SELECT count(*) FROM events), false
UNION ALL SELECT '_x', (SELECT count(*) FROM lineitem), false
UNION ALL SELECT 'plain', (SELECT count(*) FROM orders), false
UNION ALL SELECT 'broken', NULL, true
"""

LIST_TABLES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count"
    for t in SCHEMAS
)


def _measured() -> str:
    parts = []
    for t, cols in SCHEMAS.items():
        for i, (name, kind) in enumerate(cols):
            longest = f"max(length({name}))" if kind == "string" else "NULL"
            parts.append(
                f"SELECT '{t}' AS table_name, CAST({i + 1} AS INTEGER) AS ordinal, '{name}' AS name, '{kind}' AS type, "
                f"CAST({longest} AS INTEGER) AS size, count(*) > count({name}) AS nullable FROM {t}"
            )
    return " UNION ALL ".join(parts)


SEGMENTS = """
SELECT c_mktsegment AS "table", CASE c_mktsegment WHEN 'BUILDING' THEN 'error' ELSE 'count' END AS reason,
       count(DISTINCT c_custkey // 500) AS envelopes,
       CAST(count(*) + CASE c_mktsegment WHEN 'BUILDING' THEN 0 ELSE count(DISTINCT c_custkey // 500) END AS BIGINT) AS declared_rows,
       count(*) AS found_rows,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'cursor closed' END AS error
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY c_mktsegment
"""

KIND = """CASE WHEN regexp_matches({0}, '^[+-]?[0-9]+$') THEN 'int' WHEN try_cast({0} AS DOUBLE) IS NOT NULL THEN 'float'
 WHEN try_cast({0} AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'str' END"""

DATA_NAMES = """
SELECT DISTINCT source, name FROM (
  SELECT 'part' AS source, p_name AS name FROM part UNION ALL SELECT 'customer', c_name FROM customer
  UNION ALL SELECT 'pages', url FROM pages UNION ALL SELECT 'nation', n_name FROM nation
  UNION ALL SELECT 'lineitem', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') FROM lineitem)
"""


def safe(name: str, kept: str = "a-zA-Z0-9_", digit: str = "[0-9]") -> str:
    done = f"regexp_replace({name}, '[^{kept}]', '_', 'g')"
    return f"CASE WHEN {done} = '' THEN '_col' WHEN regexp_matches({done}, '^{digit}') THEN '_' || {done} ELSE {done} END"


MYSQL = {"null": "LONGTEXT", "bool": "TINYINT(1)", "int": "BIGINT", "float": "DOUBLE", "str": "MEDIUMTEXT"}


def _kind_of(name: str, kind: str) -> str:
    full = {"int": "'int'", "bigint": "'int'", "string": "'str'", "timestamp_ntz": "'str'"}.get(
        kind, f"CASE WHEN bool_or({name} <> floor({name})) THEN 'float' ELSE 'int' END"
    )
    return f"CASE WHEN count({name}) = 0 THEN 'null' ELSE {full} END"


def _widest(t: str, key: str | None = None) -> str:
    found = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS ordinal, '{n}' AS name, {_kind_of(n, k)} AS kind FROM {t}"
        for i, (n, k) in enumerate(SCHEMAS[t])
    )
    types = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MYSQL.items())
    named = f"CASE kind {types} END"
    if key:
        named = f"CASE WHEN name = '{key}' AND kind IN ('str', 'null') THEN 'VARCHAR(255)' ELSE {named} END"
    return f"SELECT ordinal, name, kind, {named} AS type FROM ({found})"


def _widest_json() -> str:
    found = " UNION ALL ".join(f"SELECT '{n}' AS name, {_kind_of(n, k)} AS kind FROM part" for n, k in SCHEMAS["part"])
    found += (
        " UNION ALL SELECT 'k', CASE WHEN bool_or(json_type(props, '$.k') = 'VARCHAR') THEN 'str'"
        " WHEN bool_or(json_type(props, '$.k') = 'DOUBLE') THEN 'float' ELSE 'int' END FROM events"
    )
    types = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MYSQL.items())
    return f"SELECT name, kind, CASE kind {types} END AS type FROM ({found})"


def _first_types() -> str:
    parts = []
    for i, (n, k) in enumerate(SCHEMAS["orders"]):
        if k in ("int", "bigint"):
            named = f"CASE WHEN {n} BETWEEN -2147483648 AND 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END"
        elif k == "double":
            named = "'DOUBLE PRECISION'"
        else:
            text = n if k == "string" else iso(n)
            named = f"CASE WHEN length({text}) <= 255 THEN 'VARCHAR(255)' ELSE 'TEXT' END"
        parts.append(
            f"SELECT CAST({i + 1} AS INTEGER) AS ordinal, '{n}' AS name, CASE WHEN {n} IS NULL THEN 'TEXT' ELSE {named} END AS type FROM first"
        )
    return "WITH first AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1) " + " UNION ALL ".join(parts)


LATEST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"


def _last_lines(first: str = "") -> str:
    return (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY {first}{LATEST}) AS rn FROM lineitem) WHERE rn = 1"
    )


KEPT_TABLES = f"SELECT * FROM ({COUNTS}) WHERE table_name NOT IN ('embeddings', 'pages', 'region')"

PLAN = f"""
SELECT t.table_name, CASE t.table_name WHEN 'events' THEN 'incremental' WHEN 'orders' THEN 'incremental'
         WHEN 'lineitem' THEN 'incremental-initial' WHEN 'conversations' THEN 'incremental-initial' ELSE 'full' END AS mode,
       CASE t.table_name WHEN 'events' THEN 'ts' WHEN 'orders' THEN 'o_orderkey' WHEN 'lineitem' THEN 'l_shipdate'
         WHEN 'conversations' THEN 'conv_id' END AS field,
       CASE t.table_name WHEN 'events' THEN 'event_id' WHEN 'conversations' THEN 'conv_id,turn' END AS pk,
       CASE t.table_name WHEN 'events' THEN 'datetime' WHEN 'orders' THEN 'int' END AS watermark_type,
       CASE t.table_name WHEN 'events' THEN (SELECT {iso('max(ts)')} FROM events WHERE ts <= TIMESTAMP '{E}')
         WHEN 'orders' THEN (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM orders) END AS watermark_value
FROM ({COUNTS}) t WHERE t.table_name NOT IN ('embeddings', 'pages')
"""

RESUME = f"""
SELECT table_name, 'full' AS mode, rows FROM
  (SELECT * FROM ({COUNTS}) WHERE table_name NOT IN ('embeddings', 'pages') ORDER BY table_name OFFSET 5)
"""

REPORT = f"""
SELECT 'customer' AS table_name, 'full' AS mode, (SELECT count(*) FROM customer) AS rows, true AS ok, CAST(NULL AS VARCHAR) AS watermark
UNION ALL SELECT 'lineitem', 'full', (SELECT count(*) FROM lineitem), true, NULL
UNION ALL SELECT 'events', 'incremental-initial', (SELECT count(*) FROM events), true, (SELECT {iso('max(ts)')} FROM events)
UNION ALL SELECT 'orders', 'incremental-initial', (SELECT count(*) FROM orders), true, (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM orders)
UNION ALL SELECT 'supplier', 'incremental-initial', 0, false, NULL
UNION ALL SELECT 'missing', 'full', 0, false, NULL
UNION ALL SELECT 'ordres', 'unknown', 0, false, NULL
"""

ALL_COLUMNS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i + 1} AS ordinal, '{n}' AS name, '{k}' AS type"
    for t, cols in SCHEMAS.items()
    for i, (n, k) in enumerate(cols)
) + " UNION ALL SELECT * FROM (" + inputs.LEGACY_CATALOG.replace("{part}", "part") + ")"

CATALOG = f"""
WITH cols AS ({ALL_COLUMNS}),
keys AS (
  SELECT table_name, name, row_number() OVER (PARTITION BY table_name ORDER BY p,
    CASE WHEN lower(stem) = lower(regexp_replace(table_name, 's$', '')) AND stem <> '' THEN 0 ELSE 1 END, ordinal) AS rn
  FROM (
    SELECT table_name, ordinal, name, p, CASE
      WHEN p IN (2, 3, 4, 5, 6) THEN regexp_extract(name, CASE p WHEN 2 THEN '(?i)^(.+?)id$' WHEN 3 THEN '(?i)^(.+?)_id$'
        WHEN 4 THEN '(?i)^(.+?)code$' WHEN 5 THEN '(?i)^(.+?)key$' ELSE '(?i)^(.+?)no$' END, 1) ELSE '' END AS stem
    FROM (SELECT *, CASE WHEN regexp_matches(name, '(?i)^id$') THEN 1 WHEN regexp_matches(name, '(?i)^.+id$') THEN 2
        WHEN regexp_matches(name, '(?i)^.+_id$') THEN 3 WHEN regexp_matches(name, '(?i)^.+code$') THEN 4
        WHEN regexp_matches(name, '(?i)^.+key$') THEN 5 WHEN regexp_matches(name, '(?i)^.+no$') THEN 6
        WHEN regexp_matches(name, '(?i)^pk_') THEN 7 END AS p FROM cols)
    WHERE p IS NOT NULL)),
times AS (
  SELECT table_name, name, type, row_number() OVER (PARTITION BY table_name ORDER BY p, ordinal) AS rn
  FROM (SELECT *, CASE WHEN regexp_matches(name, '(?i)^modified(date|on|at)?$') THEN 1
        WHEN regexp_matches(name, '(?i)^last[_ ]?modified(date|on|at)?$') THEN 2
        WHEN regexp_matches(name, '(?i)^updated(date|on|at)?$') THEN 3
        WHEN regexp_matches(name, '(?i)^last[_ ]?updated(date|on|at)?$') THEN 4
        WHEN regexp_matches(name, '(?i)^changed(date|on|at)?$') THEN 5
        WHEN regexp_matches(name, '(?i)^edit(ed)?(date|on|at)?$') THEN 6
        WHEN regexp_matches(name, '(?i)^stamp(date|on)?$') THEN 7
        WHEN regexp_matches(name, '(?i)^mtime$') THEN 8 END AS p FROM cols)
  WHERE p IS NOT NULL),
soft AS (
  SELECT table_name, name, row_number() OVER (PARTITION BY table_name ORDER BY p, ordinal) AS rn
  FROM (SELECT *, CASE WHEN lower(name) = 'deleted' THEN 1 WHEN regexp_matches(name, '(?i)^is[_ ]?deleted$') THEN 2
        WHEN lower(name) = 'active' THEN 3 WHEN regexp_matches(name, '(?i)^is[_ ]?active$') THEN 4
        WHEN lower(name) = 'status' THEN 5 WHEN lower(name) = 'recordstatus' THEN 6 END AS p FROM cols)
  WHERE p IS NOT NULL),
catalog AS (
  SELECT c.table_name, k.name AS pk,
         CASE WHEN lower(m.type) LIKE '%date%' OR lower(m.type) LIKE '%time%' THEN m.name END AS mtime_col,
         s.name AS soft_delete_col, c.column_count
  FROM (SELECT table_name, count(*) AS column_count FROM cols GROUP BY table_name) c
  LEFT JOIN (SELECT * FROM keys WHERE rn = 1) k USING (table_name)
  LEFT JOIN (SELECT * FROM times WHERE rn = 1) m USING (table_name)
  LEFT JOIN (SELECT * FROM soft WHERE rn = 1) s USING (table_name))
"""

STATE = f"""
SELECT 'events' AS source_table, 'datetime' AS watermark_type, {iso('max(ts)')} AS watermark_value, 'ts' AS watermark_field,
       'event_id' AS pk_field, count_if(ts > TIMESTAMP '{E}')::BIGINT AS last_rows FROM events
UNION ALL SELECT 'orders', 'int', CAST(max(o_orderkey) AS VARCHAR), 'o_orderkey', 'o_orderkey', count(*) FROM orders
UNION ALL SELECT 'customer', NULL, NULL, NULL, NULL, count(*) FROM customer
"""

IMPORTED = f"""
SELECT 'events' AS source_table, 'str' AS watermark_type, {iso('max(ts)')} AS watermark_value, count(*) AS last_rows,
       TIMESTAMP '2024-02-01 03:00:00' AS updated_at FROM events
UNION ALL SELECT 'orders', 'int', CAST(max(o_orderkey) AS VARCHAR), count(*), TIMESTAMP '2024-02-01 03:00:00' FROM orders
UNION ALL SELECT 'lineitem', 'str', {iso('max(l_shipdate)')}, count(*), TIMESTAMP '2024-02-01 03:00:00' FROM lineitem
UNION ALL SELECT 'part', 'float', CAST(max(p_retailprice) AS VARCHAR), count(*), TIMESTAMP '2024-02-01 03:00:00' FROM part
UNION ALL SELECT 'conversations', 'int', CAST(max(conv_id) AS VARCHAR), count(*), TIMESTAMP '2024-02-01 03:00:00' FROM conversations
"""

LOST = "('0x' || substr(md5(event_id::VARCHAR), 1, 7))::BIGINT % 20 = 0"

ORACLE = {
    "scan_full": "SELECT * FROM orders",
    "scan_incremental_int": f"SELECT * FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts <= TIMESTAMP '{E}')",
    "scan_incremental_ts": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{O}'",
    "scan_page": "SELECT * FROM customer ORDER BY c_custkey LIMIT 100 OFFSET 50",
    "scan_pages": "SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page FROM orders",
    "scan_pages_text": "SELECT page_id, url, (row_number() OVER (ORDER BY encode(url)) - 1) // 100 AS page FROM pages",
    "list_tables": LIST_TABLES,
    "table_schema": f"""SELECT table_name, ordinal, name, type, NULL::INT AS size, true AS nullable FROM ({_measured()})
        UNION ALL SELECT * FROM (VALUES ('declared', 1, 'c_custkey', 'bigint', NULL, true), ('declared', 2, 'c_name', 'varchar(25)', 25, true),
          ('declared', 3, 'c_acctbal', 'double', NULL, true), ('declared', 4, 'c_mktsegment', 'char(12)', 12, true), ('missing', NULL, NULL, NULL, NULL, NULL))""",
    "column_profile": _measured(),
    "table_count": "SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem",
    "table_count_footers": f"SELECT *, true AS from_footers FROM ({COUNTS})",
    "watermark_max_footers": """SELECT 'events' AS table_name, max(event_id)::VARCHAR AS watermark, true AS from_footers FROM events
        UNION ALL SELECT 'orders', max(o_orderkey)::VARCHAR, true FROM orders
        UNION ALL SELECT 'lineitem', max(l_shipdate)::VARCHAR, false FROM lineitem""",
    "size_probe": ODD_COUNTS.format("table_name"),
    "size_report": ODD_COUNTS.format("table"),
    "size_errors": f"SELECT table_name, rows, false AS failed FROM ({COUNTS}) UNION ALL SELECT 'missing', NULL, true",
    "size_top20": COUNTS,
    "size_totals": f"SELECT count(*) AS tables, CAST(sum(rows) AS BIGINT) AS total_rows, count_if(failed)::BIGINT AS failed FROM ({ODD_COUNTS.format('table_name')})",
    "envelope_scan": "SELECT * FROM orders",
    "envelope_untyped": "SELECT * FROM documents",
    "envelope_rejects": SEGMENTS,
    "envelope_accepts": "SELECT c_mktsegment AS \"table\", * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
    "envelope_incremental": f"SELECT * FROM events WHERE ts > TIMESTAMP '{E}'",
    "adhoc_sql": f"SELECT * REPLACE ({iso('last_order')} AS last_order) FROM ({ADHOC})",
    "adhoc_bound": f"""SELECT o_orderstatus, count(*) AS orders, {iso('max(o_orderdate)')} AS last_order FROM orders
        WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-06-15' GROUP BY o_orderstatus""",
    "watermark_coerce": f"""
        SELECT event_id, {KIND.format('id')} AS id_kind, {KIND.format('iso')} AS ts_kind, {KIND.format('v')} AS value_kind,
               {KIND.format('event_type')} AS event_type_kind, event_id AS id_mark, ts AS ts_mark
        FROM (SELECT *, CAST(event_id AS VARCHAR) AS id, {iso('ts')} AS iso, CAST(value AS VARCHAR) AS v FROM events)""",
    "state_roundtrip": "SELECT event_id, ts, value, event_type, event_type AS undecodable FROM events",
    "truncate_text": f"""SELECT 'documents' AS source, doc_id AS id, {cut('text')} AS text FROM documents
        UNION ALL SELECT 'pages', page_id, {cut('html')} FROM pages""",
    "iso_temporal": f"""SELECT 'events' AS source, event_id AS id, {iso('ts')} AS iso, strftime(ts, '%Y-%m-%d') AS iso_date FROM events
        UNION ALL SELECT 'orders', o_orderkey, {iso('o_orderdate')}, strftime(o_orderdate, '%Y-%m-%d') FROM orders""",
    "interval_seconds": """SELECT l_orderkey, l_linenumber, epoch(l_shipdate) - epoch(o_orderdate) AS seconds
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "decimal_to_double": f"""SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber, {iso('l_shipdate')} AS l_shipdate,
        CAST(CAST(l_quantity AS DECIMAL(12, 2)) AS DOUBLE) AS l_quantity, CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS DOUBLE) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(12, 2)) AS DOUBLE) AS l_discount, CAST(CAST(l_tax AS DECIMAL(12, 2)) AS DOUBLE) AS l_tax) FROM lineitem""",
    "flatten_number": """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS quantity_int,
        CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(l_extendedprice AS BIGINT) END AS price_int,
        CASE WHEN l_extendedprice <> floor(l_extendedprice) THEN l_extendedprice END AS price_float FROM lineitem""",
    "binary_to_text": f"SELECT doc_id, {cut('t')} AS text FROM (SELECT doc_id, chr(65533) || text || chr(65533) AS t FROM documents)",
    "strip_nul": "SELECT doc_id, replace(text, ' ', '') AS text FROM documents",
    "normalize_row": f"""SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, {iso('l_shipdate')} AS l_shipdate FROM lineitem""",
    "normalize_nested": "SELECT vec_id, embedding, CAST(label AS BIGINT) AS label FROM embeddings",
    "all_text": """SELECT nullif(c_acctbal, 0) AS c_acctbal, CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey, coalesce(c_name, '') AS c_name,
        CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey, coalesce(c_mktsegment, '') AS c_mktsegment
        FROM customer""",
    "sanitize_names": f"""SELECT source, name, {safe('name')} AS mysql, {safe('lower(name)')} AS postgres,
        {safe('name', kept='\\p{L}\\p{N}_', digit='\\p{Nd}')} AS sqlite FROM ({DATA_NAMES})""",
    "valid_identifiers": rf"SELECT source, name, regexp_matches(name, '^[A-Za-z_][A-Za-z0-9_\-$#]*$') AS valid FROM ({DATA_NAMES})",
    "name_collisions": f"""SELECT lang, {safe('word')} AS safe_name, count(DISTINCT word) AS names, min(word) AS first_name, max(word) AS last_name
        FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
        GROUP BY lang, {safe('word')} HAVING count(DISTINCT word) > 1""",
    "target_rows": """SELECT c_custkey AS cust_key, replace(c_name, '#', '') AS cust_name, CAST(c_nationkey AS BIGINT) AS _2nd,
        c_acctbal AS acct_bal, c_mktsegment FROM customer""",
    "infer_types_wide": _widest("lineitem"),
    "infer_types_merged": _widest("lineitem"),
    "infer_types_json": _widest_json(),
    "infer_types_first": _first_types(),
    "pk_check": _widest("customer", "c_name"),
    "target_ddl": """SELECT 'mysql' AS target, '`Cust_Key` BIGINT, `cust_NAME` MEDIUMTEXT, `_2nd` BIGINT, `ACCT_BAL` '
          || CASE WHEN bool_and(c_acctbal = floor(c_acctbal)) THEN 'BIGINT' ELSE 'DOUBLE' END
          || ', `c_mktsegment` MEDIUMTEXT, PRIMARY KEY (`Cust_Key`)' AS ddl FROM customer
        UNION ALL SELECT 'sqlite', '"Cust_Key" TEXT, "cust_NAME" TEXT, "_2nd" TEXT, "ACCT_BAL" TEXT, "c_mktsegment" TEXT, PRIMARY KEY ("Cust_Key")'""",
    "watermark_max": f"""SELECT user_id, event_type, greatest(TIMESTAMP '{E}', max(CASE WHEN value > 5 THEN ts END)) AS watermark
        FROM events GROUP BY user_id, event_type""",
    "merge_append": f"SELECT *, CASE WHEN ts > TIMESTAMP '{E}' THEN strftime(ts, '%Y-%m-%d') END AS seen FROM events",
    "merge_upsert": f"SELECT * REPLACE (CASE WHEN ts > TIMESTAMP '{E}' - INTERVAL 3 DAY THEN value * 2 ELSE value END AS value) FROM events",
    "merge_upsert_lines": _last_lines(f"(l_shipdate > TIMESTAMP '{L}') DESC, "),
    "upsert_collated": """SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_name WHEN c_custkey % 3 = 0 THEN upper(c_name)
          WHEN c_custkey % 3 = 1 THEN replace(c_name, 'o', 'ö') || '  ' ELSE replace(c_name, 'e', 'É') END AS c_name,
        * EXCLUDE (c_custkey, c_name) REPLACE (c_acctbal + (c_custkey % 2 = 0)::INT AS c_acctbal) FROM customer""",
    "dedupe_last": _last_lines(),
    "skip_tables": KEPT_TABLES,
    "unknown_policy": f"""SELECT p.table_name, rows, rows IS NOT NULL AS known
        FROM (VALUES ('embeddings'), ('pages'), ('events'), ('orders'), ('lineitem'), ('conversations'), ('lineitems')) p(table_name) LEFT JOIN ({COUNTS}) c USING (table_name)""",
    "plan_modes": PLAN,
    "resume_slice": RESUME,
    "full_refresh": "SELECT * FROM orders",
    "full_refresh_stamped": "SELECT *, true AS _synced_at FROM orders",
    "full_refresh_unkeyed": "SELECT * FROM lineitem",
    "incremental_run": "SELECT * FROM events",
    "incremental_append": "SELECT * FROM lineitem",
    "incremental_slices": "SELECT * FROM lineitem",
    "incremental_growth": _last_lines(),
    "incremental_replay": "SELECT * FROM events",
    "incremental_lookback": "SELECT * FROM events",
    "deletes_found": f"SELECT event_id FROM events WHERE {LOST}",
    "deletes_reconciled": f"SELECT * FROM events WHERE NOT {LOST}",
    "state_table": f"SELECT *, true AS published FROM ({STATE})",
    "state_import": f"SELECT *, false AS published FROM ({IMPORTED})",
    "import_then_run": "SELECT * FROM events",
    "orphan_versions": f"SELECT 'events' AS table_name, CAST(1 AS BIGINT) AS folders, count(*) AS rows, max(ts) AS last_ts FROM events WHERE ts > TIMESTAMP '{E}'",
    "run_report": f"SELECT *, NOT ok AS failed FROM ({REPORT})",
    "run_summary": f"""SELECT count_if(ok)::BIGINT AS succeeded, count_if(NOT ok)::BIGINT AS failed,
        string_agg(CASE WHEN NOT ok THEN table_name END, ',' ORDER BY table_name) AS failed_tables,
        CAST(sum(rows) AS BIGINT) AS rows, true AS duration_sec, count(*) AS next_index, count(*) AS total_tables FROM ({REPORT})""",
    "infer_pk": f"{CATALOG} SELECT table_name, pk FROM catalog",
    "infer_mtime": f"{CATALOG} SELECT table_name, mtime_col FROM catalog",
    "infer_soft_delete": f"{CATALOG} SELECT table_name, soft_delete_col FROM catalog",
    "infer_catalog": f"""{CATALOG} SELECT *, CASE WHEN mtime_col IS NOT NULL THEN 'incremental' ELSE 'full_refresh' END AS sync_strategy FROM catalog""",
    "catalog_summary": f"""{CATALOG} SELECT count(*) AS tables, count(pk) AS with_pk, count(mtime_col) AS with_mtime,
        count(soft_delete_col) AS with_soft_delete, CAST(1 AS BIGINT) AS errors FROM catalog""",
    "stream_upsert": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
    "stream_late": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
    "stream_append": "SELECT * FROM lineitem",
    "flagship": """SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users, max(ts) AS last_ts,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value FROM events GROUP BY event_type""",
}
