"""Nested catalog: object inventory (N3), catalog entries and document
(N1), and the flat form (N2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import file_type
from ..sources.catalog_doc import COLUMN_META, OBJECT_ENTRY
from .filters import non_empty

META_FIELDS = [f.name for f in COLUMN_META]


def inventory(tables: DataFrame, views: DataFrame, *, schema_col: str = "SCHEMA_NAME",
              table_col: str = "TABLE_NAME", view_col: str = "VIEW_NAME",
              readable_col: str = "readable") -> DataFrame:
    """Tables and readable views per schema as (schema, object, kind)."""
    t = tables.select(F.col(schema_col).alias("schema"), F.col(table_col).alias("object"),
                      F.lit("table").alias("kind"))
    v = (views.where(F.coalesce(F.col(readable_col), F.lit(False)))
         .select(F.col(schema_col).alias("schema"), F.col(view_col).alias("object"), F.lit("view").alias("kind")))
    return t.unionByName(v)


def catalog_entries(objects: DataFrame, columns: DataFrame, counts: DataFrame | None = None, *,
                    include_views: bool = True, map_types: bool = False) -> DataFrame:
    """N1, per object: (schema, kind, object, entry) where entry holds the
    columns ordered by position, the row count (tables), the access flag and,
    with `map_types`, the file type of every column.

    `objects`: (schema, object, kind); `columns`: normalised metadata with
    (schema, object); `counts`: (schema, object, row_count) or None when
    counting is off. Tables with zero or unknown counts are left out when
    counted; views are kept. Columns are grouped per object, a group bounded
    by the width of one table.
    """
    ordered = F.struct(F.col("ORDINAL_POSITION").alias("_pos"), F.struct(*META_FIELDS).alias("m"))
    cols = (columns.groupBy("schema", "object")
            .agg(F.transform(F.array_sort(F.collect_list(ordered)), lambda x: x["m"]).alias("columns")))
    objs = objects if include_views else objects.where(F.col("kind") == "table")
    if counts is not None:
        objs = objs.join(counts.select("schema", "object", "row_count"), ["schema", "object"], "left")
        objs = objs.withColumn("row_count", F.when(F.col("kind") == "table", F.col("row_count")))
        tables = non_empty(objs.where(F.col("kind") == "table"))
        objs = tables.unionByName(objs.where(F.col("kind") == "view"))
    else:
        objs = objs.withColumn("row_count", F.lit(None).cast("long"))
    j = objs.join(cols, ["schema", "object"], "left")
    col_list = F.coalesce(F.col("columns"), F.array().cast(OBJECT_ENTRY["columns"].dataType))
    file_cols = (F.transform(col_list, lambda c: F.struct(
        c["COLUMN_NAME"].alias("name"),
        file_type(c["DATA_TYPE"], c["NUMERIC_PRECISION"], c["NUMERIC_SCALE"], c["CHARACTER_MAXIMUM_LENGTH"]).alias("type")))
        if map_types else F.lit(None).cast(OBJECT_ENTRY["pyarrow_cols"].dataType))
    entry = F.struct(col_list.alias("columns"), F.col("row_count").cast("long").alias("row_count"),
                     F.lit(True).alias("access_ok"), file_cols.alias("pyarrow_cols"))
    return j.select("schema", "kind", "object", entry.alias("entry"))


def build_catalog(entries: DataFrame, generated_at: str, include_views: bool = True) -> DataFrame:
    """N1 document form: one row per schema with maps name → entry for tables
    and views, names sorted, like the reference's single document. A
    schema's map is built in one task, so its size is bounded by the objects
    of one schema; the per-object `catalog_entries` (written one line each by
    `write_catalog`) is the form that scales without such a bound."""
    def section(kind):
        item = F.when(F.col("kind") == kind, F.struct(F.col("object").alias("k"), F.col("entry").alias("v")))
        return F.map_from_entries(F.array_sort(F.collect_list(item)))
    views = section("view") if include_views else F.lit(None).cast("map<string," + OBJECT_ENTRY.simpleString() + ">")
    return (entries.groupBy("schema")
            .agg(section("table").alias("tables"), views.alias("views"))
            .select(F.lit(generated_at).alias("generated_at"), "schema", "tables", "views"))


def flatten_catalog(cat: DataFrame) -> DataFrame:
    """One row per schema, object, kind and column; an object without
    columns gives one row with null column fields; the count may be unknown.
    Takes per-object entries or the per-schema document."""
    if "entry" in cat.columns:
        objs = cat.select("schema", "kind", "object", "entry")
    else:
        def section(field, kind):
            return (cat.select("schema", F.explode(F.col(field)).alias("object", "entry"))
                    .withColumn("kind", F.lit(kind)))
        objs = section("tables", "table").unionByName(section("views", "view"))
    flat = objs.select("schema", "kind", "object", F.col("entry.row_count").alias("row_count"),
                       F.col("entry.access_ok").alias("access_ok"),
                       F.explode_outer("entry.columns").alias("c"))
    return flat.select("schema", "kind", "object", "row_count", "access_ok",
                       *[F.col("c")[f].alias(f) for f in META_FIELDS])
