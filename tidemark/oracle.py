"""DuckDB SQL equal to each registered query (the correctness oracle).

Each statement runs on the same Parquet tables, registered as views under
their own names, and returns the same columns under the same names.
"""

from __future__ import annotations

from .fixed import GUID_PATTERN, SYSTEM_SCHEMA_NAMES, SYSTEM_SCHEMA_PREFIX
from .plans import fixtures as X
from .tables import TABLES
from .registry import TAG_CANDIDATES

LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
                 "l_tax, l_returnflag, l_linestatus, l_shipdate")
LINEITEM_NOKEY = ", ".join(f"l.{c.strip()}" for c in LINEITEM_COLS.split(",")[1:])


def guid(kind: int, expr: str) -> str:
    return f"concat(lpad('{kind}', 8, '0'), '-0000-4000-8000-', lpad(CAST({expr} AS VARCHAR), 12, '0'))"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


CHANGE_ROWS = f"""
SELECT CASE WHEN l.l_orderkey IS NULL THEN 2 ELSE 4 END AS "__rowMarker__", o.o_orderkey AS l_orderkey,
       {LINEITEM_NOKEY}
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderkey IS NOT NULL
"""

MIRROR_BATCH = f"""
WITH m AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 3 AS a,
                  min(o_orderkey) + 2 * (max(o_orderkey) - min(o_orderkey)) // 3 AS b FROM orders)
SELECT 1 AS seq, 0 AS "__watermark", 'u' AS "__op", 0 AS "__deleted", CAST(NULL AS INTEGER) AS "__rowMarker__",
       {LINEITEM_COLS}
FROM lineitem
UNION ALL
SELECT CASE WHEN o.o_orderkey <= m.b THEN 2 ELSE 3 END, NULL, NULL, NULL,
       CASE WHEN l.l_orderkey IS NULL THEN 2 ELSE 4 END, o.o_orderkey, {LINEITEM_NOKEY}
FROM orders o CROSS JOIN m LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderkey > m.a
"""

_MARKS = """m AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 3 AS a,
                  min(o_orderkey) + 2 * (max(o_orderkey) - min(o_orderkey)) // 3 AS b FROM orders)"""

MIRROR_POLL = f"""
WITH {_MARKS}
SELECT CASE WHEN o.o_orderkey <= m.a THEN 1 WHEN o.o_orderkey <= m.b THEN 2 ELSE 3 END AS seq,
       CASE WHEN l.l_orderkey IS NULL THEN 2 ELSE 4 END AS "__rowMarker__", o.o_orderkey AS l_orderkey, {LINEITEM_NOKEY}
FROM orders o CROSS JOIN m LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderkey IS NOT NULL
"""

CHANGES_RANGE = f"""
WITH {_MARKS}
SELECT CASE WHEN o.o_orderkey <= m.b THEN 2 ELSE 3 END AS seq,
       CASE WHEN l.l_orderkey IS NULL THEN 2 ELSE 4 END AS "__rowMarker__", o.o_orderkey AS l_orderkey, {LINEITEM_NOKEY}
FROM orders o CROSS JOIN m LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderkey > m.a
"""

CONFORM_COLUMNS = """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
       substring(CAST(l_partkey AS VARCHAR), 1, 3) AS l_partkey, CAST(l_quantity AS DOUBLE) AS l_quantity,
       CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, substring(CAST(l_returnflag AS VARCHAR), 1, 1) AS l_returnflag,
       substring(CAST(l_linestatus AS VARCHAR), 1, 1) AS l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate,
       CAST(l_suppkey AS INTEGER) AS l_suppkey
FROM lineitem
"""

CONFORM_DECIMAL = """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(l_discount AS DECIMAL(4,2)) AS l_discount, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice
FROM lineitem
"""

CONFORM_TRY = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
       substring(CAST(o_orderstatus AS VARCHAR), 1, 1) AS o_orderstatus, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate
FROM orders
"""

_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in X.TYPE_NAMES) + "]"

NORMALISED_META = f"""
raw AS (
  SELECT p_partkey AS k, p_brand AS "SCHEMA_NAME", p_type AS "TABLE_NAME", p_size,
         CASE WHEN p_partkey % 7 <> 0 THEN concat(p_name, '_', CAST(p_partkey AS VARCHAR)) END AS cn,
         concat('C', CAST(p_partkey AS VARCHAR)) AS c2,
         {_TYPE_LIST}[p_partkey % {len(X.TYPE_NAMES)} + 1] AS tname
  FROM part),
meta AS (
  SELECT "SCHEMA_NAME", "TABLE_NAME",
         coalesce(nullif(cn, ''), nullif(c2, '')) AS "COLUMN_NAME",
         coalesce(nullif(CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN NULL ELSE tname END, ''),
                  nullif(CASE WHEN k % 4 <= 1 THEN lower(tname) END, '')) AS "DATA_TYPE",
         CAST(CASE WHEN k % 11 <> 0 THEN p_size * 40 END AS BIGINT) AS "CHARACTER_MAXIMUM_LENGTH",
         CAST(p_size % 39 AS BIGINT) AS "NUMERIC_PRECISION",
         CAST(k % 5 AS BIGINT) AS "NUMERIC_SCALE",
         CASE WHEN k % 3 = 0 THEN 'NO' WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END AS "IS_NULLABLE",
         CAST(k AS BIGINT) AS "ORDINAL_POSITION"
  FROM raw)
"""


def _default(col: str, d: int) -> str:
    return f"CAST(CASE WHEN {col} IS NULL OR {col} = 0 THEN {d} ELSE {col} END AS VARCHAR)"


_DT = "upper(coalesce(\"DATA_TYPE\", ''))"
_P = _default('"NUMERIC_PRECISION"', 38)
_S = _default('"NUMERIC_SCALE"', 0)
_L = '"CHARACTER_MAXIMUM_LENGTH"'

CAST_RULE = f"""CASE
  WHEN contains({_DT}, 'DECIMAL') OR starts_with({_DT}, 'NUMERIC') THEN concat('DECIMAL(', {_P}, ',', {_S}, ')')
  WHEN contains({_DT}, 'BIGINT') THEN 'BIGINT'
  WHEN contains({_DT}, 'SMALLINT') THEN 'SMALLINT'
  WHEN contains({_DT}, 'TINYINT') THEN 'TINYINT'
  WHEN contains({_DT}, 'INT') THEN 'INTEGER'
  WHEN contains({_DT}, 'DOUBLE') OR contains({_DT}, 'REAL') OR contains({_DT}, 'FLOAT') THEN 'DOUBLE'
  WHEN contains({_DT}, 'SECONDDATE') OR contains({_DT}, 'TIMESTAMP') THEN 'TIMESTAMP'
  WHEN contains({_DT}, 'DATE') THEN 'DATE'
  WHEN contains({_DT}, 'BINARY') OR contains({_DT}, 'BLOB') THEN 'BLOB'
  WHEN contains({_DT}, 'NVARCHAR') THEN concat('NVARCHAR(', {_default(_L, 5000)}, ')')
  WHEN contains({_DT}, 'VARCHAR') THEN concat('VARCHAR(', {_default(_L, 5000)}, ')')
  WHEN contains({_DT}, 'CHAR') THEN concat('CHAR(', {_default(_L, 1)}, ')')
  ELSE 'VARCHAR(8000)' END"""

FILE_RULE = f"""CASE
  WHEN contains({_DT}, 'DECIMAL') OR starts_with({_DT}, 'NUMERIC') THEN concat('decimal128(', {_P}, ',', {_S}, ')')
  WHEN contains({_DT}, 'INT') THEN 'int64'
  WHEN contains({_DT}, 'DOUBLE') OR contains({_DT}, 'REAL') OR contains({_DT}, 'FLOAT') THEN 'float64'
  WHEN contains({_DT}, 'TIMESTAMP') OR contains({_DT}, 'DATE') THEN 'timestamp'
  WHEN contains({_DT}, 'BINARY') OR contains({_DT}, 'BLOB') THEN 'binary'
  WHEN {_L} IS NOT NULL AND {_L} <> 0 AND {_L} < 1024 THEN 'string'
  ELSE 'large_string' END"""

COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS object, count(*) AS row_count FROM {t}" for t in TABLES)

CATALOG_FLAT = f"""
WITH cols AS (
  SELECT table_name AS object, column_name AS "COLUMN_NAME", CAST(ordinal_position AS BIGINT) AS "ORDINAL_POSITION"
  FROM information_schema.columns WHERE table_name IN ({_in(TABLES)}) GROUP BY ALL),
counts AS ({COUNTS})
SELECT 'tpch' AS "schema", 'table' AS kind, c.object, n.row_count, 'YES' AS "IS_NULLABLE", c."COLUMN_NAME",
       c."ORDINAL_POSITION"
FROM cols c JOIN counts n ON n.object = c.object WHERE n.row_count > 0
UNION ALL
SELECT 'tpch', 'view', 'open_orders', CAST(NULL AS BIGINT), 'YES', v.c, CAST(v.p AS BIGINT)
FROM (VALUES ('o_orderkey', 1), ('o_custkey', 2), ('o_totalprice', 3)) v(c, p)
"""

CATALOG_TOTALS = f"""
WITH counts AS ({COUNTS})
SELECT CAST(1 AS BIGINT) AS schemas, (SELECT count(*) FROM counts WHERE row_count > 0) AS tables,
       CAST(1 AS BIGINT) AS views
"""

DOMAINS = f"""
d AS (
  SELECT CAST(r_regionkey AS BIGINT) AS pos, {guid(1, 'r_regionkey')} AS id, r_name AS "displayName",
         CAST(NULL AS VARCHAR) AS "parentId" FROM region
  UNION ALL
  SELECT CAST({X.NATION_POS_BASE} + n_nationkey AS BIGINT), {guid(2, 'n_nationkey')}, n_name, {guid(1, 'n_regionkey')}
  FROM nation),
roots AS (SELECT * FROM (VALUES (0, 'EUROPE'), (1, '00000001-0000-4000-8000-000000000001'), (2, 'NATION_3'))
          r(root_pos, root)),
hits AS (SELECT r.root_pos, r.root, d.* FROM roots r JOIN d ON d.id = r.root
         UNION ALL SELECT r.root_pos, r.root, d.* FROM roots r JOIN d ON d."displayName" = r.root),
top AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY root_pos ORDER BY pos) = 1),
e AS (SELECT root_pos, root, pos, id, "displayName", "parentId", 0 AS level FROM top
      UNION ALL
      SELECT t.root_pos, t.root, d.pos, d.id, d."displayName", d."parentId", 1 FROM top t JOIN d ON d."parentId" = t.id),
w AS (SELECT {guid(2, 's_nationkey')} AS domain_id, s_suppkey AS ws_pos, {guid(3, 's_suppkey')} AS id,
             s_name AS "displayName" FROM supplier),
ew AS (SELECT e.root_pos, e.root, e.level, e.pos AS domain_pos, w.ws_pos, w.id, w."displayName"
       FROM e JOIN w ON w.domain_id = e.id)
"""

TAGS = TAG_CANDIDATES
REPORTS = f"""
pairs AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
r AS (SELECT {guid(3, 'l_suppkey')} AS workspace_id, p_partkey AS report_pos, {guid(4, 'p_partkey')} AS id,
             concat(p_name, ' ', p_brand) AS "displayName",
             p_partkey % 5 <> 0 AND (p_brand IN ({_in(TAGS)}) OR p_type IN ({_in(TAGS)})
               OR {guid(5, 'p_size')} IN ({_in(TAGS)}) OR {guid(6, 'p_size')} IN ({_in(TAGS)})) AS tagged
      FROM pairs JOIN part ON l_partkey = p_partkey)
"""

COPY_PLAN = f"""
WITH {DOMAINS}, {REPORTS},
t AS (SELECT ew.root_pos, ew.root, ew.level, ew.domain_pos, ew.ws_pos, ew.id AS workspace_id, r.report_pos,
             r.id AS report_id, r."displayName"
      FROM ew JOIN r ON r.workspace_id = ew.id WHERE r.tagged),
target AS (SELECT p_partkey AS pos, {guid(7, 'p_partkey')} AS id, concat(p_name, ' Brand#', p_size) AS name FROM part),
tfirst AS (SELECT name, arg_min(id, pos) AS tid FROM target GROUP BY name),
ranked AS (SELECT t.*, row_number() OVER (PARTITION BY t."displayName"
                                          ORDER BY root_pos, level, domain_pos, ws_pos, report_pos) AS rn FROM t)
SELECT root_pos, root, level, ws_pos, workspace_id, report_pos, report_id, ranked."displayName",
       CASE WHEN tf.tid IS NOT NULL OR rn > 1 THEN 'update' ELSE 'clone' END AS action, tf.tid AS target_report_id
FROM ranked LEFT JOIN tfirst tf ON tf.name = ranked."displayName"
"""

DUPLICATE_FLAG = ("(SELECT count(*) > 0 FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL "
                  "HAVING count(*) > 1))")

EXPORT_RUNS = f"""
SELECT 'customers' AS name, count(*) AS "rows", false AS failed FROM customer
UNION ALL
SELECT 'lineitem_keys', CASE WHEN {DUPLICATE_FLAG} THEN 0 ELSE count(*) END, {DUPLICATE_FLAG} FROM lineitem
UNION ALL
SELECT 'orders', count(*), false FROM orders
"""

RUN_OUTCOME = f"""
SELECT CAST(3 AS BIGINT) AS units, CAST(CASE WHEN {DUPLICATE_FLAG} THEN 1 ELSE 0 END AS BIGINT) AS failed,
       {DUPLICATE_FLAG} AS any_failed,
       CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)
            + CASE WHEN {DUPLICATE_FLAG} THEN 0 ELSE (SELECT count(*) FROM lineitem) END AS BIGINT) AS "rows"
"""

UNIQUE_LOOKUP = f"""
WITH per AS (SELECT concat(p_name, ' ', p_brand) AS name, count(*) AS n, min({guid(4, 'p_partkey')}) AS id
             FROM part GROUP BY 1),
inp AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 2 = 0 THEN {guid(4, 'p_partkey')}
                                     ELSE concat(p_name, ' ', p_brand) END AS value FROM part),
j AS (SELECT i.pos, i.value, coalesce(regexp_matches(i.value, '{GUID_PATTERN}'), false) AS is_id,
             coalesce(per.n, 0) AS n, per.id FROM inp i LEFT JOIN per ON per.name = i.value)
SELECT pos, value, is_id, CASE WHEN is_id THEN NULL ELSE n END AS match_count,
       CASE WHEN is_id THEN value WHEN n = 1 THEN id END AS resolved_id,
       CASE WHEN is_id THEN NULL WHEN n = 0 THEN 'no match' WHEN n > 1 THEN 'ambiguous' END AS error
FROM j
"""

_KEYS = {"lineitem": "l_orderkey, l_linenumber", "orders": "o_orderkey", "customer": "c_custkey",
         "part": "p_partkey", "events": "event_id", "conversations": "conv_id, turn"}

KEY_CHECK = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS key_count, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
        CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicates
        FROM (SELECT count(*) AS n FROM {t} GROUP BY {k})""" for t, k in sorted(_KEYS.items()))

MIRROR_STRING_MARK = """
WITH m AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 3 AS a,
                  min(o_orderkey) + 2 * (max(o_orderkey) - min(o_orderkey)) // 3 AS b FROM orders),
r AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS request, o.*, lpad(CAST(a AS VARCHAR), 12, '0') AS a,
             lpad(CAST(b AS VARCHAR), 12, '0') AS b FROM orders o CROSS JOIN m)
SELECT CASE WHEN request <= a THEN 1 WHEN request <= b THEN 2 ELSE 3 END AS seq, 4 AS "__rowMarker__",
       * EXCLUDE (request, a, b)
FROM r
"""

CATALOG_FILE_TYPES = f"""
WITH cols AS (
  SELECT table_name AS object, column_name, CAST(ordinal_position AS INTEGER) AS pos, data_type
  FROM information_schema.columns WHERE table_name IN ({_in(TABLES)}) GROUP BY ALL),
counts AS ({COUNTS}),
listed AS (
  SELECT 'table' AS kind, c.* FROM cols c JOIN counts n ON n.object = c.object WHERE n.row_count > 0
  UNION ALL
  SELECT 'view', 'open_orders', v.c, v.p, c.data_type
  FROM (VALUES ('o_orderkey', 1), ('o_custkey', 2), ('o_totalprice', 3)) v(c, p)
  JOIN cols c ON c.object = 'orders' AND c.column_name = v.c)
SELECT 'tpch' AS "schema", kind, object, pos AS "ORDINAL_POSITION", column_name AS "COLUMN_NAME",
       CASE WHEN contains(data_type, 'INT') THEN 'int64'
            WHEN contains(data_type, 'DOUBLE') OR contains(data_type, 'FLOAT') THEN 'float64'
            WHEN contains(data_type, 'TIMESTAMP') OR contains(data_type, 'DATE') THEN 'timestamp'
            ELSE 'large_string' END AS file_type
FROM listed
"""

SCHEMA_SCOPE = f"""
WITH s AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN concat('{SYSTEM_SCHEMA_PREFIX.lower()}_', c_name) ELSE c_name END AS "SCHEMA_NAME",
                  c_nationkey FROM customer),
own AS (SELECT * FROM s WHERE NOT starts_with(upper("SCHEMA_NAME"), '{SYSTEM_SCHEMA_PREFIX}')
          AND upper("SCHEMA_NAME") NOT IN ({_in(SYSTEM_SCHEMA_NAMES)})),
u AS (SELECT 'all' AS scope, * FROM own UNION ALL SELECT 'all_by_scope', * FROM own
      UNION ALL SELECT 'listed', * FROM s WHERE "SCHEMA_NAME" IN ('Customer#000000001', 'Customer#000000002', 'Customer#000000004')
      UNION ALL SELECT 'default', * FROM s WHERE "SCHEMA_NAME" = 'Customer#000000005')
SELECT *, CAST(row_number() OVER (PARTITION BY scope ORDER BY "SCHEMA_NAME", c_nationkey) AS INTEGER) AS place FROM u
"""

COPY_PLAN_NAMED = f"""
WITH {DOMAINS}, {REPORTS},
t AS (SELECT ew.root_pos, ew.level, ew.domain_pos, ew.ws_pos, ew.id AS workspace_id, r.report_pos,
             r.id AS report_id, r."displayName"
      FROM ew JOIN r ON r.workspace_id = ew.id WHERE r.tagged),
ws AS (SELECT {guid(3, 's_suppkey')} AS wid FROM supplier WHERE s_name = 'Supplier#000000001'),
tfirst AS (SELECT "displayName" AS name, arg_min(id, report_pos) AS tid FROM r JOIN ws ON r.workspace_id = wid GROUP BY 1),
ranked AS (SELECT t.*, row_number() OVER (PARTITION BY t."displayName"
                                          ORDER BY root_pos, level, domain_pos, ws_pos, report_pos) AS rn FROM t)
SELECT root_pos, level, ws_pos, workspace_id, report_pos, report_id, ranked."displayName",
       CASE WHEN tf.tid IS NOT NULL OR rn > 1 THEN 'update' ELSE 'clone' END AS action, tf.tid AS target_report_id,
       (SELECT wid FROM ws) AS target_workspace_id
FROM ranked LEFT JOIN tfirst tf ON tf.name = ranked."displayName"
"""

LISTING_CHAIN = """
WITH p AS (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS n, CAST(count(*) AS INTEGER) AS n_items FROM orders GROUP BY 1),
e AS (SELECT min(n) AS last FROM p WHERE n + 1 NOT IN (SELECT n FROM p)), f AS (SELECT min(n) AS first, max(n) AS top FROM p)
SELECT concat('orders?page=', n) AS url, CASE WHEN n <= last THEN n - first END AS place,
       CASE WHEN n <= last THEN 'page' ELSE 'unreached' END AS status, CAST(1 AS BIGINT) AS copies, n_items FROM p, e, f
UNION ALL SELECT concat('orders?page=', last + 1), last + 1 - first, 'missing', 0, NULL FROM e, f WHERE last < top
"""

UNION_PARTS = """
SELECT r_regionkey AS key, r_name AS name, 0 AS part_pos FROM region
UNION ALL SELECT n_nationkey, n_name, 1 FROM nation
UNION ALL SELECT s_suppkey, NULL, 2 FROM supplier
"""

ORACLE = {
    "schema_scope": SCHEMA_SCOPE,
    "union_parts": UNION_PARTS,
    "mirror_then_stream": MIRROR_BATCH,
    "mirror_poll": MIRROR_POLL,
    "changes_range": CHANGES_RANGE,
    "mirror_string_mark": MIRROR_STRING_MARK,
    "catalog_conform_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "flatten_mixed_pages": "SELECT page_id AS page_no, 0 AS item_pos, html AS item FROM pages WHERE trim(html) <> ''",
    "catalog_file_types": CATALOG_FILE_TYPES,
    "delta_change_rows": CHANGE_ROWS,
    "mirror_batch": MIRROR_BATCH,
    "mirror_sql": MIRROR_BATCH,
    "mirror_stream": CHANGE_ROWS,
    "full_refresh_envelope": 'SELECT 0 AS "__watermark", \'u\' AS "__op", 0 AS "__deleted", * FROM customer',
    "conform_columns": CONFORM_COLUMNS,
    "conform_decimal": CONFORM_DECIMAL,
    "conform_try_cast": CONFORM_TRY,
    "cast_type_rules": f"WITH {NORMALISED_META} SELECT *, {CAST_RULE} AS cast_type FROM meta",
    "file_type_rules": f"WITH {NORMALISED_META} SELECT *, {FILE_RULE} AS file_type FROM meta",
    "query_source_named": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS max_price,
               min(o_orderdate) AS first_date, CAST(sum(o_custkey) AS BIGINT) AS sum_custkey
        FROM orders WHERE o_orderdate > TIMESTAMP '1900-01-01 00:00:00' AND o_orderstatus <> 'no such status'
        GROUP BY o_orderstatus, o_orderpriority""",
    "query_source_positional": """
        SELECT c_mktsegment, count(*) AS n_customers FROM customer WHERE c_acctbal > -1.0e18 GROUP BY c_mktsegment""",
    "read_pruned": "SELECT l_orderkey, l_quantity FROM lineitem",
    "export_snapshot": """
        SELECT o_orderkey AS "PK1", o_orderdate AS "WM1", o_orderkey AS "WM2", o_custkey, o_orderstatus, o_totalprice
        FROM orders""",
    "export_increment": f"""
        WITH {_MARKS} SELECT o_orderkey AS "PK1", CAST(floor(o_orderkey / 1000) AS BIGINT) AS "WM1", o_orderkey AS "WM2", o_custkey
        FROM orders, m WHERE o_orderkey > a""",
    "export_folder_twice": """
        SELECT 'events' AS name, count(*) AS "rows", false AS failed FROM events
        UNION ALL SELECT 'orders', count(*), false FROM orders
        UNION ALL SELECT 'events', 0, false UNION ALL SELECT 'orders', 0, false""",
    "export_runs": EXPORT_RUNS,
    "run_outcome": RUN_OUTCOME,
    "part_files": f"SELECT {LINEITEM_COLS} FROM lineitem",
    "next_watermark": "SELECT max(event_id) AS watermark FROM events WHERE event_id > 0",
    "next_watermark_ts": "SELECT max(ts) AS watermark FROM events",
    "key_check": KEY_CHECK,
    "max_column": "SELECT max(value) FILTER (WHERE NOT isnan(value)) AS max_value FROM events",
    "max_tuple": 'SELECT o_orderdate AS "WM1", o_orderkey AS "WM2" FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1',
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1""",
    "table_counts": f"SELECT object AS table_name, row_count FROM ({COUNTS}) WHERE row_count > 0",
    "top_n": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100",
    "catalog_flat": CATALOG_FLAT,
    "catalog_nested": CATALOG_FLAT,
    "catalog_conform": f"SELECT {LINEITEM_COLS} FROM lineitem",
    "catalog_totals": CATALOG_TOTALS,
    "column_fallback": """
        WITH t AS (SELECT doc_id, 'quality' AS "COLUMN_NAME", 1 AS "ORDINAL_POSITION", CAST(quality AS VARCHAR) AS value
                   FROM labels
                   UNION ALL SELECT doc_id, 'toxic', 2, CAST(toxic AS VARCHAR) FROM labels),
             v AS (SELECT doc_id, 'lang' AS "COLUMN_NAME", 1 AS "ORDINAL_POSITION", lang AS value FROM documents
                   UNION ALL SELECT doc_id, 'source', 2, source FROM documents)
        SELECT *, 'table' AS col_source FROM t
        UNION ALL
        SELECT *, 'view' FROM v WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = v.doc_id)""",
    "flatten_pages": """
        SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS page_no,
               CAST(row_number() OVER (PARTITION BY floor(o_orderkey / 100) ORDER BY o_orderkey) - 1 AS INTEGER) AS item_pos,
               o_orderkey AS id, o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS totalprice
        FROM orders""",
    "domain_children": f"WITH {DOMAINS} SELECT * FROM e",
    "domain_workspaces": f"WITH {DOMAINS} SELECT * FROM ew",
    "workspace_counts": f"WITH {DOMAINS} SELECT root_pos, root, count(*) AS n_workspaces FROM ew GROUP BY root_pos, root",
    "tagged_reports": f"""
        WITH {REPORTS}, w AS (SELECT {guid(3, 's_suppkey')} AS wid, s_name AS workspace_name FROM supplier)
        SELECT r.workspace_id, w.workspace_name, r.report_pos, r.id, r."displayName"
        FROM r JOIN w ON w.wid = r.workspace_id WHERE r.tagged""",
    "tagged_report_counts": f"""
        WITH {REPORTS}, w AS (SELECT {guid(3, 's_suppkey')} AS wid, s_name AS workspace_name FROM supplier)
        SELECT r.workspace_id, w.workspace_name, count(*) AS n_reports
        FROM r JOIN w ON w.wid = r.workspace_id WHERE r.tagged GROUP BY r.workspace_id, w.workspace_name""",
    "unique_lookup": UNIQUE_LOOKUP,
    "copy_plan": COPY_PLAN,
    "copy_plan_named": COPY_PLAN_NAMED,
    "listing_chain": LISTING_CHAIN,
    "sorted_snapshot": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS overlaps FROM lineitem",
}
