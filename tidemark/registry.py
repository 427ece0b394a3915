"""Registered queries: one per operator group of the survey inventory.

Each takes (spark, sf_dir), reads the given tables (or frames Spark derives
from them) and returns a DataFrame. Queries that exercise sinks or state
write into a fresh folder under the session's work root and return what was
written, read back.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import aggregates as A
from .operators import joins as J
from .fixed import SYSTEM_SCHEMA_PREFIX
from .operators.filters import in_schemas, mark_range, non_system_schemas
from .operators.nested import flatten_catalog
from .operators.ordering import head, ordered_metadata, placed, sorted_files
from .operators.project import conform, envelope, normalise_columns
from .functions.types import cast_type, file_type
from .plans import fixtures as X
from .plans.catalog import conform_from_catalog, count_tables, profile
from .plans.export import export, export_all, export_folder, read_run_log
from .plans.mirror import MirrorSpec, mirror, specs_in_folder
from .plans.report_copy import report_copy_plan
from .session import scratch_dir
from .sources import paths
from .sources.catalog_doc import read_catalog, read_document, write_catalog, write_document
from .sources.chains import follow_pages
from .sources.files import read_changes, read_columns
from .sources.listings import flatten_pages, union_ordered
from .sources.sinks import write_parts
from .sources.sql import query_source
from .streaming.mirror_stream import delta_stream, stream_mirror
from .streaming.poll import poll_mirror
from .tables import TABLES, load, register_views, table_path

# Parameters of the registered queries (caller inputs in the reference).
ROOT_IDS = {"AMERICA": "00000001-0000-4000-8000-000000000001"}
TAG_CANDIDATES = ["Brand#2", "00000006-0000-4000-8000-000000000007"]
CATALOG_SCHEMA = "tpch"
GENERATED_AT = "2026-01-01T00:00:00"
FAR_PAST = dt.datetime(1900, 1, 1)


def _roots():
    return ["EUROPE", ROOT_IDS["AMERICA"], "NATION_3"]


# -- change feed ------------------------------------------------------------

def delta_change_rows(spark: SparkSession, sf: str) -> DataFrame:
    """F1 + J1 + P5: change rows of every delta request (no watermark is set,
    so all are new). They are read once and cover most of the snapshot, so they
    are not staged: a second scan of its key column costs less than a copy."""
    return J.change_rows(load(spark, sf, "orders"), load(spark, sf, "lineitem"), delta_key="o_orderkey",
                         snap_key="l_orderkey", mark="o_orderkey")


def _mirror_spec(sf: str) -> MirrorSpec:
    return MirrorSpec(name="lineitem_feed", snapshot=lambda s: load(s, sf, "lineitem"), snap_key="l_orderkey",
                      delta=lambda s: load(s, sf, "orders"), delta_key="o_orderkey", mark="o_orderkey",
                      full_version=0, full_order=("l_orderkey", "l_linenumber"))


def mirror_marks(spark: SparkSession, sf: str) -> tuple[int, int, int]:
    lo, hi = load(spark, sf, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return lo + (hi - lo) // 3, lo + 2 * (hi - lo) // 3, hi


def mirror_batch(spark: SparkSession, sf: str) -> DataFrame:
    """T1-T3 + S6 + S7: a full run while the delta table reached mark a, delta
    runs at b and at the maximum, then a run with nothing new (no sequence).
    Returns every sequence read back."""
    root = scratch_dir(spark, "mirror")
    spec = _mirror_spec(sf)
    a, b, top = mirror_marks(spark, sf)
    for high in (a, b, top, top):
        res = mirror(spark, spec, root, high=high)
        if res.error:
            raise RuntimeError(res.error)
    return read_changes(spark, root, spec.name)


MIRROR_FULL_SQL = """SELECT 0 AS __watermark, 'u' AS __op, 0 AS __deleted, m.*
FROM lineitem AS m ORDER BY m.l_orderkey, m.l_linenumber"""

MIRROR_DELTA_SQL = """SELECT CASE WHEN m.l_orderkey IS NULL THEN 2 ELSE 4 END AS __rowMarker__,
  d.o_orderkey AS l_orderkey, m.l_partkey, m.l_suppkey, m.l_linenumber, m.l_quantity, m.l_extendedprice,
  m.l_discount, m.l_tax, m.l_returnflag, m.l_linestatus, m.l_shipdate
FROM orders AS d LEFT JOIN lineitem AS m ON m.l_orderkey = d.o_orderkey
WHERE d.o_orderkey > {WATERMARK} AND d.o_orderkey <= :high
ORDER BY d.o_orderkey"""


def mirror_sql(spark: SparkSession, sf: str) -> DataFrame:
    """T1-T3 driven by SQL files in a folder (full.sql, delta.sql with a
    {WATERMARK} slot, mirror.json): the same runs as `mirror_batch`."""
    register_views(spark, sf, ["orders", "lineitem"])
    root = scratch_dir(spark, "mirror-sql")
    folder = f"{root}/_queries"
    paths.write_text(spark, f"{folder}/lineitem_feed/full.sql", MIRROR_FULL_SQL)
    paths.write_text(spark, f"{folder}/lineitem_feed/delta.sql", MIRROR_DELTA_SQL)
    paths.write_text(spark, f"{folder}/lineitem_feed/mirror.json",
                     json.dumps({"watermark_table": "orders", "watermark_column": "o_orderkey"}))
    (feed,) = specs_in_folder(spark, folder)
    a, b, top = mirror_marks(spark, sf)
    for high in (a, b, top, top):
        res = mirror(spark, feed, root, high=high)
        if res.error:
            raise RuntimeError(res.error)
    return read_changes(spark, root, feed.name)


def mirror_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Delta requests arrive in three rounds by mark, each consumed by
    the restarted streaming query; the change rows equal the batch result."""
    root = scratch_dir(spark, "stream")
    a, b, top = mirror_marks(spark, sf)
    _stream_rounds(spark, sf, root, "lineitem_stream", (None, a, b, top))
    return read_changes(spark, root, "lineitem_stream").drop("seq")


def _stream_rounds(spark: SparkSession, sf: str, root: str, name: str, marks: tuple) -> None:
    """Appends the requests between successive marks to the source folder and
    runs the stream after each."""
    src, orders = f"{root}/_source/orders", load(spark, sf, "orders")
    for low, high in zip(marks, marks[1:]):
        orders.where(mark_range("o_orderkey", low, high)).write.mode("append").parquet(src)
        stream_mirror(spark, delta_stream(spark, src), lambda s: load(s, sf, "lineitem"), name=name, root=root,
                      delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")


def mirror_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    """T1 + T7: a batch full run at mark a, then the stream goes on with the
    same feed; the sequences equal those of `mirror_batch`."""
    root = scratch_dir(spark, "mirror-stream")
    spec = _mirror_spec(sf)
    a, b, top = mirror_marks(spark, sf)
    res = mirror(spark, spec, root, high=a)
    if res.error:
        raise RuntimeError(res.error)
    _stream_rounds(spark, sf, root, spec.name, (a, b, top))
    return read_changes(spark, root, spec.name)


def mirror_poll(spark: SparkSession, sf: str) -> DataFrame:
    """The request table is polled as it grows to the marks a, b and its
    maximum, and once more with nothing new; each poll that finds requests
    becomes one sequence."""
    root = scratch_dir(spark, "mirror-poll")
    spec = _mirror_spec(sf)
    a, b, top = mirror_marks(spark, sf)
    for high in (a, b, top, top):
        poll_mirror(spark, spec, root, high=high)
    return read_changes(spark, root, spec.name)


def changes_range(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences after the first of a feed, read by number: the full
    refresh's folder is not listed, nor are its columns in the result."""
    root = scratch_dir(spark, "mirror-range")
    spec = _mirror_spec(sf)
    for high in mirror_marks(spark, sf):
        res = mirror(spark, spec, root, high=high)
        if res.error:
            raise RuntimeError(res.error)
    return read_changes(spark, root, spec.name, low=1, high=3)


def mirror_string_mark(spark: SparkSession, sf: str) -> DataFrame:
    """T1 with text marks (zero-padded request numbers): three delta runs
    read every request once."""
    root = scratch_dir(spark, "mirror-text")
    def requests(s):
        return load(s, sf, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("request"), "o_orderkey")
    spec = MirrorSpec(name="requests", snapshot=lambda s: load(s, sf, "orders"), snap_key="o_orderkey", delta=requests,
                      delta_key="o_orderkey", mark="request", mode="delta")
    for high in [str(m).rjust(12, "0") for m in mirror_marks(spark, sf)]:
        res = mirror(spark, spec, root, high=high)
        if res.error:
            raise RuntimeError(res.error)
    return read_changes(spark, root, spec.name)


def catalog_conform_documents(spark: SparkSession, sf: str) -> DataFrame:
    """P1 on text without a declared length: all of it comes back."""
    objects = {(CATALOG_SCHEMA, t): ("table", load(spark, sf, t)) for t in ("documents", "embeddings")}
    path = f"{scratch_dir(spark, 'catalog')}/catalog.json"
    write_catalog(profile(spark, objects, all_schemas=True), path, GENERATED_AT)
    out = conform_from_catalog(load(spark, sf, "documents"), read_catalog(spark, path), CATALOG_SCHEMA, "documents")
    return out.select("doc_id", "text", "lang", "source", "n_chars")


def flatten_mixed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """S8 on pages that are no JSON: each is one item, as it came."""
    pages = load(spark, sf, "pages").select(F.col("page_id").alias("page_no"), F.col("html").alias("body"))
    return flatten_pages(pages).select("page_no", "item_pos", "item")


def full_refresh_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """P4 + O1: the full-refresh form of a snapshot, ordered by key."""
    return envelope(load(spark, sf, "customer"), version=0).orderBy("c_custkey")


# -- conform / declared types -----------------------------------------------

LINEITEM_SPEC = [
    {"COLUMN_NAME": "l_orderkey", "DATA_TYPE": "BIGINT", "ORDINAL_POSITION": 1},
    {"COLUMN_NAME": "l_linenumber", "DATA_TYPE": "SMALLINT", "ORDINAL_POSITION": 2},
    {"COLUMN_NAME": "l_partkey", "DATA_TYPE": "NVARCHAR", "CHARACTER_MAXIMUM_LENGTH": 3, "ORDINAL_POSITION": 3},
    {"COLUMN_NAME": "l_quantity", "DATA_TYPE": "DOUBLE", "ORDINAL_POSITION": 4},
    {"COLUMN_NAME": "l_extendedprice", "DATA_TYPE": "REAL", "ORDINAL_POSITION": 5},
    {"COLUMN_NAME": "l_returnflag", "DATA_TYPE": "NVARCHAR", "CHARACTER_MAXIMUM_LENGTH": 1, "ORDINAL_POSITION": 6},
    {"COLUMN_NAME": "l_linestatus", "DATA_TYPE": "CHAR", "ORDINAL_POSITION": 7},
    {"COLUMN_NAME": "l_shipdate", "DATA_TYPE": "DATE", "ORDINAL_POSITION": 8},
    {"COLUMN_NAME": "l_suppkey", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 9},
    {"COLUMN_NAME": "", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 10},
]

DECIMAL_SPEC = [
    {"COLUMN_NAME": "l_orderkey", "DATA_TYPE": "BIGINT", "ORDINAL_POSITION": 1},
    {"COLUMN_NAME": "l_linenumber", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 2},
    {"COLUMN_NAME": "l_discount", "DATA_TYPE": "DECIMAL", "NUMERIC_PRECISION": 4, "NUMERIC_SCALE": 2,
     "ORDINAL_POSITION": 3},
    {"COLUMN_NAME": "l_extendedprice", "DATA_TYPE": "DECIMAL", "NUMERIC_PRECISION": 15, "NUMERIC_SCALE": 2,
     "ORDINAL_POSITION": 4},
]

ORDERS_TRY_SPEC = [
    {"COLUMN_NAME": "o_orderkey", "DATA_TYPE": "BIGINT", "ORDINAL_POSITION": 1},
    {"COLUMN_NAME": "o_orderpriority", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 2},
    {"COLUMN_NAME": "o_orderstatus", "DATA_TYPE": "NVARCHAR", "CHARACTER_MAXIMUM_LENGTH": 1, "ORDINAL_POSITION": 3},
    {"COLUMN_NAME": "o_orderdate", "DATA_TYPE": "SECONDDATE", "ORDINAL_POSITION": 4},
]


def conform_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Declared casts, metadata order, text cut to its length."""
    return conform(load(spark, sf, "lineitem"), LINEITEM_SPEC, on_long_text="truncate")


def conform_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """P1 with DECIMAL(p, s) columns."""
    return conform(load(spark, sf, "lineitem"), DECIMAL_SPEC)


def conform_try_cast(spark: SparkSession, sf: str) -> DataFrame:
    """P1 with on_error='null': values that do not cast become null."""
    return conform(load(spark, sf, "orders"), ORDERS_TRY_SPEC, on_error="null")


def _normalised_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_columns(X.column_metadata(spark, sf), keep=("SCHEMA_NAME", "TABLE_NAME"))


def _rule_args(m: DataFrame):
    return (m["DATA_TYPE"], m["NUMERIC_PRECISION"], m["NUMERIC_SCALE"], m["CHARACTER_MAXIMUM_LENGTH"])


def cast_type_rules(spark: SparkSession, sf: str) -> DataFrame:
    """P6 + P2: normalised metadata and the cast type of every column."""
    m = _normalised_metadata(spark, sf)
    return m.withColumn("cast_type", cast_type(*_rule_args(m)))


def file_type_rules(spark: SparkSession, sf: str) -> DataFrame:
    """P6 + P3: normalised metadata and the file type of every column."""
    m = _normalised_metadata(spark, sf)
    return m.withColumn("file_type", file_type(*_rule_args(m)))


# -- sources, exports --------------------------------------------------------

QUERY_SOURCE_SQL = ("SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS max_price, "
                    "min(o_orderdate) AS first_date, sum(o_custkey) AS sum_custkey FROM orders "
                    "WHERE o_orderdate > :since AND o_orderstatus <> :skip GROUP BY o_orderstatus, o_orderpriority")


def query_source_named(spark: SparkSession, sf: str) -> DataFrame:
    """S1 with named, typed parameters."""
    register_views(spark, sf, ["orders"])
    return query_source(spark, QUERY_SOURCE_SQL, {"since": FAR_PAST, "skip": "no such status"})


def query_source_positional(spark: SparkSession, sf: str) -> DataFrame:
    """S1 with positional parameters."""
    register_views(spark, sf, ["customer"])
    return query_source(spark, "SELECT c_mktsegment, count(*) AS n_customers FROM customer "
                               "WHERE c_acctbal > ? GROUP BY c_mktsegment", [-1.0e18])


def read_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """S3: only two columns are read from the file."""
    return read_columns(spark, table_path(sf, "lineitem"), ["l_orderkey", "l_quantity"])


EXPORT_SQL = ("SELECT o_orderkey AS PK1, o_orderdate AS WM1, o_orderkey AS WM2, o_custkey, o_orderstatus, o_totalprice "
              "FROM orders WHERE o_orderdate > :wm1 OR (o_orderdate = :wm1 AND o_orderkey > :wm2)")


def export_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """T4 + F2 + A5 + S4 + A6: a first export from an initial mark, then a
    second run bound to the largest (WM1, WM2) of the first output: nothing
    new, so the first snapshot stays. Returns the snapshot read back."""
    register_views(spark, sf, ["orders"])
    target = f"{scratch_dir(spark, 'export')}/orders"
    first = export(spark, "orders", EXPORT_SQL, target, initial=(FAR_PAST, -1))
    second = export(spark, "orders", EXPORT_SQL, target, initial=(FAR_PAST, -1))
    if first.error or second.error or second.rows != 0:
        raise RuntimeError(f"unexpected export results: {first} {second}")
    return spark.read.parquet(target)


INCREMENT_SQL = ("SELECT o_orderkey AS PK1, CAST(floor(o_orderkey / 1000) AS BIGINT) AS WM1, o_orderkey AS WM2, o_custkey "
                 "FROM orders_so_far WHERE floor(o_orderkey / 1000) > :wm1 "
                 "OR (floor(o_orderkey / 1000) = :wm1 AND o_orderkey > :wm2)")


def export_increment(spark: SparkSession, sf: str) -> DataFrame:
    """T4 + F2 with a second run that finds rows: the table grows after the
    first export, and the second replaces the snapshot by the rows above the
    largest (WM1, WM2) of the first."""
    orders, (a, _, _) = load(spark, sf, "orders"), mirror_marks(spark, sf)
    target = f"{scratch_dir(spark, 'increment')}/orders"
    for rows in (orders.where(F.col("o_orderkey") <= a), orders):
        rows.createOrReplaceTempView("orders_so_far")
        res = export(spark, "orders", INCREMENT_SQL, target, initial=(-1, -1))
        if res.error:
            raise RuntimeError(res.error)
    return spark.read.parquet(target)


FOLDER_FILES = {
    "orders.sql": "SELECT o_orderkey AS PK1, o_orderdate AS WM1, o_orderkey AS WM2 FROM orders "
                  "WHERE o_orderdate > {WM1} OR (o_orderdate = {WM1} AND o_orderkey > {WM2})",
    "events.sql": "SELECT event_id AS PK1, event_id AS WM1, value FROM events WHERE event_id > {WM1}",
    "initial.json": json.dumps({"orders": ["1900-01-01T00:00:00", -1], "events": [-1]}),
}


def export_folder_twice(spark: SparkSession, sf: str) -> DataFrame:
    """T5 over a folder of SQL files whose first tuples stand in its
    initial.json, two statements at a time; a second run finds nothing new.
    Returns the run log."""
    register_views(spark, sf, ["orders", "events"])
    root = scratch_dir(spark, "sql-folder")
    for name, text in FOLDER_FILES.items():
        paths.write_text(spark, f"{root}/queries/{name}", text)
    for _ in range(2):
        export_folder(spark, f"{root}/queries", f"{root}/out", parallel=2)
    log = read_run_log(spark, f"{root}/out/_runs")
    return log.select("name", "rows", F.col("error").isNotNull().alias("failed"))


EXPORT_FOLDER = {
    "customers": "SELECT c_custkey AS PK_CUST, c_name, c_acctbal FROM customer",
    "lineitem_keys": "SELECT l_orderkey AS PK1, l_linenumber AS PK2, l_quantity FROM lineitem",
    "orders": "SELECT o_orderkey AS PK1, o_orderdate AS WM1, o_orderkey AS WM2 FROM orders",
}


def _export_folder(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, sf, ["customer", "lineitem", "orders"])
    out = scratch_dir(spark, "folder")
    export_all(spark, EXPORT_FOLDER, out)
    return read_run_log(spark, f"{out}/_runs")


def export_runs(spark: SparkSession, sf: str) -> DataFrame:
    """T5 + T6 + A5: every statement runs; the one with repeated keys fails
    alone and is logged with its error."""
    log = _export_folder(spark, sf)
    return log.select("name", "rows", F.col("error").isNotNull().alias("failed"))


def run_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up of a folder run."""
    return A.run_outcome(_export_folder(spark, sf))


def part_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of at most 20,000 rows each, read back."""
    out = f"{scratch_dir(spark, 'parts')}/lineitem"
    write_parts(load(spark, sf, "lineitem"), out, 20_000)
    return spark.read.parquet(out)


# -- aggregates ---------------------------------------------------------------

def next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the new high-water mark from no saved mark."""
    return A.watermark_after(load(spark, sf, "events"), "event_id", None)


def max_column(spark: SparkSession, sf: str) -> DataFrame:
    """A4: column maximum, NaN and null skipped."""
    return A.max_column(load(spark, sf, "events"), "value")


def max_tuple(spark: SparkSession, sf: str) -> DataFrame:
    """A3: largest (WM1, WM2) tuple, columns found by prefix."""
    o = load(spark, sf, "orders").select(F.col("o_orderdate").alias("WM1"), F.col("o_orderkey").alias("WM2"))
    return A.max_tuple(o)


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A5: repeated (l_orderkey, l_linenumber) pairs with their counts."""
    return A.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
        "part": ["p_partkey"], "events": ["event_id"], "conversations": ["conv_id", "turn"]}


def key_check(spark: SparkSession, sf: str) -> DataFrame:
    """A5 over several tables: distinct keys, duplicate keys, rows in them."""
    parts = [A.key_summary(load(spark, sf, t), KEYS[t], t) for t in sorted(KEYS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def next_watermark_ts(spark: SparkSession, sf: str) -> DataFrame:
    """A2 on a timestamp mark (no saved mark: no lower bound)."""
    return A.watermark_after(load(spark, sf, "events"), "ts", None)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A1 + F4: all tables counted in groups, empty ones left out."""
    rows = count_tables(spark, {(CATALOG_SCHEMA, t): (lambda t=t: load(spark, sf, t)) for t in TABLES})
    counts = spark.createDataFrame([(name, n) for _, name, n in rows], "table_name string, row_count long")
    return counts.where(F.col("row_count") > 0)


def top_n(spark: SparkSession, sf: str) -> DataFrame:
    """O3: first 100 orders by (date, key) - a top-n, not a full sort."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return head(o, 100, order_by=["o_orderdate", "o_orderkey"])


# -- catalog -----------------------------------------------------------------

def catalog_objects(spark: SparkSession, sf: str) -> dict:
    objs = {(CATALOG_SCHEMA, t): ("table", load(spark, sf, t)) for t in TABLES}
    o = load(spark, sf, "orders")
    objs[(CATALOG_SCHEMA, "open_orders")] = ("view", o.where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_custkey", "o_totalprice"), True)
    objs[(CATALOG_SCHEMA, "restricted_orders")] = ("view", o, False)
    objs[("SYS_STATISTICS", "region_copy")] = ("table", load(spark, sf, "region"))
    return objs


def _catalog_entries(spark: SparkSession, sf: str, map_types: bool = False) -> DataFrame:
    return profile(spark, catalog_objects(spark, sf), map_types=map_types, all_schemas=True)


def catalog_flat(spark: SparkSession, sf: str) -> DataFrame:
    """N3 + P6 + A1 + F4 + F6 + N1 + S9 + S10 + N2: profile the tables and a
    view, write the per-object catalog, read it back and flatten."""
    path = f"{scratch_dir(spark, 'catalog')}/catalog.json"
    write_catalog(_catalog_entries(spark, sf), path, GENERATED_AT)
    flat = flatten_catalog(read_catalog(spark, path))
    return flat.select("schema", "kind", "object", "row_count", "IS_NULLABLE", "COLUMN_NAME", "ORDINAL_POSITION")


def catalog_nested(spark: SparkSession, sf: str) -> DataFrame:
    """N1 + S9 + S10 + N2 in the nested form: the catalog as one JSON document
    (schemas, their tables and views), written in ordered parts and read back."""
    path = f"{scratch_dir(spark, 'catalog')}/document"
    write_document(_catalog_entries(spark, sf), path, GENERATED_AT)
    flat = flatten_catalog(read_document(spark, path))
    return flat.select("schema", "kind", "object", "row_count", "IS_NULLABLE", "COLUMN_NAME", "ORDINAL_POSITION")


def catalog_file_types(spark: SparkSession, sf: str) -> DataFrame:
    """N1 with map_types: the file type of every catalogued column."""
    e = _catalog_entries(spark, sf, map_types=True)
    return e.select("schema", "kind", "object", F.posexplode("entry.pyarrow_cols").alias("pos", "c")) \
        .select("schema", "kind", "object", (F.col("pos") + 1).alias("ORDINAL_POSITION"),
                F.col("c.name").alias("COLUMN_NAME"), F.col("c.type").alias("file_type"))


def catalog_conform(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + S10 + N2 + P2 + P1: profile the tables, write and read the
    catalog document, then cast `lineitem` to the types it declares (the
    Spark form of regenerating a CAST query from the catalog)."""
    path = f"{scratch_dir(spark, 'catalog')}/catalog.json"
    write_catalog(_catalog_entries(spark, sf), path, GENERATED_AT)
    return conform_from_catalog(load(spark, sf, "lineitem"), read_catalog(spark, path), CATALOG_SCHEMA, "lineitem")


def catalog_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Schemas, tables and views in the catalog."""
    return A.catalog_totals(_catalog_entries(spark, sf))


def column_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Label facts where a document has labels, else document facts."""
    lab = load(spark, sf, "labels")
    doc = load(spark, sf, "documents")
    table_cols = lab.select("doc_id", F.lit("quality").alias("COLUMN_NAME"), F.lit(1).alias("ORDINAL_POSITION"),
                            F.col("quality").cast("string").alias("value")).unionByName(
        lab.select("doc_id", F.lit("toxic").alias("COLUMN_NAME"), F.lit(2).alias("ORDINAL_POSITION"),
                   F.col("toxic").cast("string").alias("value")))
    view_cols = doc.select("doc_id", F.lit("lang").alias("COLUMN_NAME"), F.lit(1).alias("ORDINAL_POSITION"),
                           F.col("lang").alias("value")).unionByName(
        doc.select("doc_id", F.lit("source").alias("COLUMN_NAME"), F.lit(2).alias("ORDINAL_POSITION"),
                   F.col("source").alias("value")))
    return J.columns_of(table_cols, view_cols, keys=("doc_id",))


def _schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Schema names made of the customers', every third a system schema."""
    c = load(spark, sf, "customer")
    system = F.concat(F.lit(SYSTEM_SCHEMA_PREFIX.lower()), F.lit("_"), F.col("c_name"))
    return c.select(F.when(F.col("c_custkey") % 3 == 0, system).otherwise(F.col("c_name")).alias("SCHEMA_NAME"),
                    "c_nationkey")


def schema_scope(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + F6 + O2: schemas in scope when all are asked for, one by default,
    or a list, in name order with their place in it."""
    s = _schemas(spark, sf)
    scopes = {"all": ordered_metadata(non_system_schemas(s), "SCHEMA_NAME"),
              "all_by_scope": in_schemas(s, all_schemas=True),
              "listed": in_schemas(s, schemas=["Customer#000000001", "Customer#000000002", "Customer#000000004"]),
              "default": in_schemas(s, default_schema="Customer#000000005")}
    parts = [d.select(F.lit(k).alias("scope"), "SCHEMA_NAME", "c_nationkey") for k, d in scopes.items()]
    rows = placed(reduce(DataFrame.unionByName, parts), "scope", ["SCHEMA_NAME", "c_nationkey"], f"{scratch_dir(spark, 'schemas')}/rows")
    return rows.withColumn("place", F.col("place").cast("int"))


def sorted_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """O1: lineitem written in key order, and what its files then show: rows
    that stand before a smaller key in their file, and files whose keys
    overlap (none of either)."""
    keys, path = ["l_orderkey", "l_linenumber"], f"{scratch_dir(spark, 'sorted')}/lineitem"
    sorted_files(load(spark, sf, "lineitem"), keys).write.parquet(path)
    rows = spark.read.parquet(path).select(F.struct(*keys).alias("k"), F.col("_metadata.file_name").alias("f"),
                                           F.col("_metadata.row_index").alias("i"))
    after = F.lead("k").over(Window.partitionBy("f").orderBy("i"))
    files = rows.withColumn("after", after).groupBy("f").agg(
        F.count("*").alias("n"), F.count_if(F.col("after") < F.col("k")).alias("bad"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    # One row per file; keys may repeat across the edge of two files.
    gap = F.lead("lo").over(Window.orderBy("lo", "hi"))
    return files.withColumn("next", gap).agg(
        F.sum("n").alias("n_rows"), F.sum("bad").alias("out_of_order"), F.count_if(F.col("next") < F.col("hi")).alias("overlaps"))


def union_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Listings united by name, each row with the part it came from."""
    return union_ordered([load(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")),
                          load(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key")),
                          load(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))])


# -- listings and report copy ------------------------------------------------

def flatten_order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON pages (objects and bare arrays) to one row per order."""
    items = flatten_pages(X.order_pages(spark, sf))
    return items.select("page_no", "item_pos", F.from_json("item", X.ORDER_ITEM).alias("o")).select(
        "page_no", "item_pos", "o.*")


def domain_children(spark: SparkSession, sf: str) -> DataFrame:
    """Each root and its direct children."""
    return J.with_children(X.domains(spark, sf), _roots())


def _expanded_workspaces(spark: SparkSession, sf: str) -> DataFrame:
    return J.domain_workspaces(J.with_children(X.domains(spark, sf), _roots()), X.workspaces(spark, sf))


def domain_workspaces(spark: SparkSession, sf: str) -> DataFrame:
    """J4 + O4: workspaces of every root's domains, duplicates kept."""
    return _expanded_workspaces(spark, sf).select("root_pos", "root", "level", "domain_pos", "ws_pos", "id",
                                                  "displayName")


def workspace_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Workspaces per root."""
    return A.count_by(_expanded_workspaces(spark, sf), "root_pos", "root", alias="n_workspaces")


def tagged_reports(spark: SparkSession, sf: str) -> DataFrame:
    """F5 + J5: reports of every workspace with any candidate tag."""
    r = J.tagged_reports(X.workspaces(spark, sf), X.reports(spark, sf), TAG_CANDIDATES)
    return r.select("workspace_id", "workspace_name", "report_pos", "id", "displayName")


def tagged_report_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tagged reports per workspace (workspaces without any drop out)."""
    r = J.tagged_reports(X.workspaces(spark, sf), X.reports(spark, sf), TAG_CANDIDATES)
    return A.count_by(r, "workspace_id", "workspace_name", alias="n_reports")


def unique_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Ids pass, names must match exactly one report name."""
    p = load(spark, sf, "part")
    name = X.report_name(F.col("p_name"), F.col("p_brand"))
    dim = p.select(X.guid(X.REPORT, F.col("p_partkey")).alias("id"), name.alias("displayName"))
    inputs = p.select(F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 2 == 0,
                      X.guid(X.REPORT, F.col("p_partkey"))).otherwise(name).alias("value"))
    return J.resolve_unique(inputs, dim)


def copy_plan(spark: SparkSession, sf: str) -> DataFrame:
    """E4 end to end: domain listing pages (S8) → J3 → J4 → F5/J5 → J7."""
    doms = X.parse_domains(X.domain_pages(spark, sf))
    plan = report_copy_plan(doms, X.workspaces(spark, sf), X.reports(spark, sf), X.target_reports(spark, sf),
                            _roots(), TAG_CANDIDATES)
    return plan.select("root_pos", "root", "level", "ws_pos", "workspace_id", "report_pos", "report_id",
                       "displayName", "action", "target_report_id")


def copy_plan_named(spark: SparkSession, sf: str) -> DataFrame:
    """E4 with J6: the target workspace is given by name, and the reports it
    already has are found in the listing of all workspaces' reports."""
    reports = X.reports(spark, sf)
    listed = reports.select("workspace_id", F.col("report_pos").alias("pos"), "id", F.col("displayName").alias("name"))
    plan = report_copy_plan(X.domains(spark, sf), X.workspaces(spark, sf), reports, listed, _roots(), TAG_CANDIDATES,
                            target_workspace="Supplier#000000001")
    return plan.select("root_pos", "level", "ws_pos", "workspace_id", "report_pos", "report_id", "displayName", "action",
                       "target_report_id", "target_workspace_id")


def listing_chain(spark: SparkSession, sf: str) -> DataFrame:
    """The pages of a listing put in order by following their links."""
    pages = X.order_listing(spark, sf)
    first = pages.select(F.min(F.regexp_extract("url", r"(\d+)$", 1).cast("long"))).first()[0]
    rows = follow_pages(spark, pages, f"orders?page={first}")
    return rows.select("url", "place", "status", "copies", F.json_array_length(F.get_json_object("body", "$.value")).alias("n_items"))


QUERIES = {
    "delta_change_rows": delta_change_rows,
    "mirror_batch": mirror_batch,
    "mirror_sql": mirror_sql,
    "mirror_stream": mirror_stream,
    "mirror_then_stream": mirror_then_stream,
    "mirror_poll": mirror_poll,
    "changes_range": changes_range,
    "mirror_string_mark": mirror_string_mark,
    "catalog_conform_documents": catalog_conform_documents,
    "flatten_mixed_pages": flatten_mixed_pages,
    "catalog_file_types": catalog_file_types,
    "full_refresh_envelope": full_refresh_envelope,
    "conform_columns": conform_columns,
    "conform_decimal": conform_decimal,
    "conform_try_cast": conform_try_cast,
    "cast_type_rules": cast_type_rules,
    "file_type_rules": file_type_rules,
    "query_source_named": query_source_named,
    "query_source_positional": query_source_positional,
    "read_pruned": read_pruned,
    "export_snapshot": export_snapshot,
    "export_increment": export_increment,
    "export_folder_twice": export_folder_twice,
    "export_runs": export_runs,
    "run_outcome": run_outcome,
    "part_files": part_files,
    "next_watermark": next_watermark,
    "next_watermark_ts": next_watermark_ts,
    "max_column": max_column,
    "max_tuple": max_tuple,
    "duplicate_keys": duplicate_keys,
    "key_check": key_check,
    "table_counts": table_counts,
    "top_n": top_n,
    "catalog_flat": catalog_flat,
    "catalog_nested": catalog_nested,
    "catalog_conform": catalog_conform,
    "catalog_totals": catalog_totals,
    "schema_scope": schema_scope,
    "union_parts": union_parts,
    "column_fallback": column_fallback,
    "flatten_pages": flatten_order_pages,
    "domain_children": domain_children,
    "domain_workspaces": domain_workspaces,
    "workspace_counts": workspace_counts,
    "tagged_reports": tagged_reports,
    "tagged_report_counts": tagged_report_counts,
    "unique_lookup": unique_lookup,
    "copy_plan": copy_plan,
    "copy_plan_named": copy_plan_named,
    "listing_chain": listing_chain,
    "sorted_snapshot": sorted_snapshot,
}
