"""Shape the given test tables into the inputs the reference works on.

Everything here is a Spark transformation of the input tables, so its size
follows theirs:
- region + nation → a domain listing (regions are roots, nations their
  children), packed into JSON listing pages;
- supplier → workspaces, one per supplier, in its nation's domain;
- distinct (supplier, part) pairs of lineitem → reports, named after the
  part, tagged with its brand and type (untagged for every 5th part);
- part → the target workspace's existing reports (one each), and synthetic column
  metadata for the declared-type rules;
- orders → JSON listing pages of 100 orders each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import load

# Kind digits used in the synthetic ids below (test shaping only).
REGION, NATION, WORKSPACE, REPORT, BRAND_TAG, TYPE_TAG, TARGET = 1, 2, 3, 4, 5, 6, 7
NATION_POS_BASE = 1_000_000

# Declared type names cycled through the synthetic column metadata (test
# shaping only; they cover every rule branch of the cast and file type maps).
TYPE_NAMES = ["DECIMAL", "NUMERIC", "BIGINT", "SMALLINT", "TINYINT", "INTEGER", "DOUBLE", "REAL",
              "SECONDDATE", "TIMESTAMP", "DATE", "NVARCHAR", "VARCHAR", "CHAR", "VARBINARY",
              "BLOB", "ST_POINT", "ALPHANUM", "TEXT", "BOOLEAN"]


def guid(kind: int, key: Column) -> Column:
    """A hyphenated 8-4-4-4-12 id built from a kind digit and a key."""
    return F.concat(F.lpad(F.lit(str(kind)), 8, "0"), F.lit("-0000-4000-8000-"),
                    F.lpad(key.cast("string"), 12, "0"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, id, displayName, parentId): regions first, then nations."""
    r = load(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("pos"), guid(REGION, F.col("r_regionkey")).alias("id"),
        F.col("r_name").alias("displayName"), F.lit(None).cast("string").alias("parentId"))
    n = load(spark, sf_dir, "nation").select(
        (F.lit(NATION_POS_BASE) + F.col("n_nationkey")).cast("long").alias("pos"),
        guid(NATION, F.col("n_nationkey")).alias("id"), F.col("n_name").alias("displayName"),
        guid(REGION, F.col("n_regionkey")).alias("parentId"))
    return r.unionByName(n)


def pack_pages(items: DataFrame, page_of: Column, order: Column, fields: list[str], list_key: str,
               base_url: str) -> DataFrame:
    """(page_no, body): items grouped into JSON pages `{list_key: [...],
    continuationUri: ...}`. A page holds a bounded number of items."""
    item = F.struct(order.alias("_o"), F.struct(*[F.col(f) for f in fields]).alias("v"))
    pages = items.groupBy(page_of.alias("page_no")).agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias("items"))
    link = F.concat(F.lit(base_url), (F.col("page_no") + 1).cast("string"))
    return pages.select("page_no", F.to_json(F.struct(F.col("items").alias(list_key),
                                                       link.alias("continuationUri"))).alias("body"))


def domain_pages(spark: SparkSession, sf_dir: str, page_size: int = 10) -> DataFrame:
    d = domains(spark, sf_dir)
    rank = F.when(F.col("pos") >= NATION_POS_BASE, F.col("pos") - NATION_POS_BASE + 100).otherwise(F.col("pos"))
    return pack_pages(d, F.floor(rank / page_size).cast("long"), F.col("pos"),
                      ["id", "displayName", "parentId"], "value", "admin/domains?page=")


DOMAIN_ITEM = "id string, displayName string, parentId string"


def parse_domains(pages: DataFrame) -> DataFrame:
    """Listing pages → (pos, id, displayName, parentId), pos = listing order."""
    from ..sources.listings import flatten_pages
    items = flatten_pages(pages)
    parsed = items.select((F.col("page_no") * 1_000_000 + F.col("item_pos")).alias("pos"),
                          F.from_json("item", DOMAIN_ITEM).alias("d"))
    return parsed.select("pos", "d.*")


def workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(guid(NATION, F.col("s_nationkey")).alias("domain_id"), F.col("s_suppkey").alias("ws_pos"),
                    guid(WORKSPACE, F.col("s_suppkey")).alias("id"), F.col("s_name").alias("displayName"))


def report_name(p_name: Column, p_brand: Column) -> Column:
    return F.concat(p_name, F.lit(" "), p_brand)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    p = load(spark, sf_dir, "part")
    tags = F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(F.array(
        F.struct(guid(BRAND_TAG, F.col("p_size")).alias("id"), F.col("p_brand").alias("displayName")),
        F.struct(guid(TYPE_TAG, F.col("p_size")).alias("id"), F.col("p_type").alias("displayName"))))
    return pairs.join(p, pairs["l_partkey"] == p["p_partkey"]).select(
        guid(WORKSPACE, F.col("l_suppkey")).alias("workspace_id"), F.col("p_partkey").alias("report_pos"),
        guid(REPORT, F.col("p_partkey")).alias("id"), report_name(F.col("p_name"), F.col("p_brand")).alias("displayName"),
        tags.alias("tags"))


def target_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target workspace's reports: one per part, named with a brand made of
    its size, so a name is there already for some of the reports to copy."""
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("pos"), guid(TARGET, F.col("p_partkey")).alias("id"),
                    report_name(F.col("p_name"), F.concat(F.lit("Brand#"), F.col("p_size").cast("string"))).alias("name"))


ORDER_ITEM = "id long, custkey long, status string, totalprice double"


def order_pages(spark: SparkSession, sf_dir: str, page_size: int = 100, list_key: str = "items") -> DataFrame:
    """Orders as listing pages; every third page is a bare JSON array."""
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalprice"))
    pages = pack_pages(o, F.floor(F.col("id") / page_size).cast("long"), F.col("id"),
                       ["id", "custkey", "status", "totalprice"], list_key, "orders?page=")
    bare = F.get_json_object(F.col("body"), f"$.{list_key}")
    return pages.select("page_no", F.when(F.col("page_no") % 3 == 2, bare).otherwise(F.col("body")).alias("body"))


def order_listing(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """(url, body): orders as pages that each name the next; the last names none."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("custkey"))
    pages = pack_pages(o, F.floor(F.col("id") / page_size).cast("long"), F.col("id"), ["id", "custkey"], "value", "orders?page=")
    last = F.col("page_no") == pages.select(F.max("page_no")).scalar()
    bare = F.to_json(F.struct(F.from_json(F.get_json_object("body", "$.value"), "array<struct<id:long,custkey:long>>").alias("value")))
    return pages.select(F.concat(F.lit("orders?page="), F.col("page_no").cast("string")).alias("url"),
                        F.when(last, bare).otherwise(F.col("body")).alias("body"))


def column_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, system-table-like column metadata, one row per part, with the
    alias fields a catalog source may use (name / type in different fields,
    empty strings, zero precision, nullable as flag or text)."""
    p = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tname = F.element_at(F.array(*[F.lit(t) for t in TYPE_NAMES]), (k % len(TYPE_NAMES) + 1).cast("int"))
    return p.select(
        F.col("p_brand").alias("SCHEMA_NAME"), F.col("p_type").alias("TABLE_NAME"),
        F.when(k % 7 != 0, F.concat(F.col("p_name"), F.lit("_"), k.cast("string"))).alias("COLUMN_NAME"),
        F.concat(F.lit("C"), k.cast("string")).alias("COLUMN"),
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(None)).otherwise(tname).alias("SQL_TYPE_NAME"),
        F.when(k % 4 <= 1, F.lower(tname)).alias("DATA_TYPE_NAME"),
        F.when(k % 11 != 0, F.col("p_size") * 40).cast("long").alias("LENGTH"),
        (F.col("p_size") % 39).cast("long").alias("PRECISION"),
        (k % 5).cast("long").alias("SCALE"),
        F.when(k % 3 == 0, F.lit("NO")).alias("IS_NULLABLE"),
        (k % 2 == 0).alias("NULLABLE"),
        k.alias("POSITION"),
    )
