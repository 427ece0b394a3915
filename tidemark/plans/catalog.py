"""Catalog profiling (E3): inventory → columns → counts → entries → document.

The objects and their column lists are metadata (bounded by the number of
objects and their width); the row counts are distributed jobs over groups of
tables.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.nested import catalog_entries, inventory
from ..operators.project import normalise_columns
from .units import run_units

RAW_COLUMNS = ("SCHEMA_NAME string, OBJECT_NAME string, COLUMN_NAME string, DATA_TYPE_NAME string, "
               "LENGTH long, PRECISION long, SCALE long, NULLABLE boolean, POSITION long")


def _raw_columns(schema: str, name: str, st: T.StructType) -> list[tuple]:
    out = []
    for i, f in enumerate(st.fields, start=1):
        dtype = f.dataType
        prec = dtype.precision if isinstance(dtype, T.DecimalType) else None
        scale = dtype.scale if isinstance(dtype, T.DecimalType) else None
        out.append((schema, name, f.name, dtype.simpleString().upper(), None, prec, scale, f.nullable, i))
    return out


def system_tables(spark: SparkSession, objects: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The system-table view of a set of frames: (tables, views, columns).

    `objects` maps (schema, name) to (kind, DataFrame[, readable]).
    """
    tables, views, cols = [], [], []
    for (schema, name), spec in sorted(objects.items()):
        kind, df = spec[0], spec[1]
        readable = spec[2] if len(spec) > 2 else True
        if kind == "table":
            tables.append((schema, name))
        else:
            views.append((schema, name, readable))
        cols.extend(_raw_columns(schema, name, df.schema))
    return (spark.createDataFrame(tables, "SCHEMA_NAME string, TABLE_NAME string"),
            spark.createDataFrame(views, "SCHEMA_NAME string, VIEW_NAME string, readable boolean"),
            spark.createDataFrame(cols, RAW_COLUMNS))


COUNTS = "schema string, object string, row_count long"


def _count_part(schema: str, name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(schema).alias("schema"), F.lit(name).alias("object"), "row_count")


def object_counts(objects: dict) -> DataFrame:
    """A1 keyed by (schema, object): one union job over the tables (lazy)."""
    return _union_of_counts([(k, spec[1]) for k, spec in sorted(objects.items()) if spec[0] == "table"])


def _union_of_counts(tables: list) -> DataFrame:
    return reduce(DataFrame.unionByName, [_count_part(schema, name, df) for (schema, name), df in tables])


#: Tables counted by one job, and jobs at a time.
COUNT_GROUP = 32
COUNT_JOBS = 4


def count_tables(spark: SparkSession, tables: dict, *, group: int = COUNT_GROUP, jobs: int = COUNT_JOBS) -> list[tuple]:
    """A1: (schema, object, rows) of (schema, object) -> DataFrame, or a
    function that builds one. Tables are counted in groups of fixed size, a few
    groups at a time, so the plan of a job never grows with the number of
    tables. A count reads no column: Parquet gives it from its footers. If a
    group fails, its tables are counted one by one, and one that fails by
    itself has an unknown (null) count."""
    def build(df) -> DataFrame:
        return df if isinstance(df, DataFrame) else df()

    def one(key, df):
        try:
            return (*key, _count_part(*key, build(df)).first()["row_count"])
        except Exception:
            return (*key, None)

    def together(some):
        try:
            return [tuple(r) for r in _union_of_counts([(k, build(df)) for k, df in some]).collect()]
        except Exception:
            return [one(k, df) for k, df in some]

    listed = sorted(tables.items())
    groups = [listed[i:i + group] for i in range(0, len(listed), group)]
    return [r for rows in run_units(spark, [partial(together, g) for g in groups], jobs) for r in rows]


def counted_objects(spark: SparkSession, objects: dict, *, group: int = COUNT_GROUP, jobs: int = COUNT_JOBS) -> DataFrame:
    """A1 for the catalog: the counts of its tables (see `count_tables`)."""
    tables = {k: spec[1] for k, spec in objects.items() if spec[0] == "table"}
    return spark.createDataFrame(count_tables(spark, tables, group=group, jobs=jobs), COUNTS)


def in_scope(objects: dict, schemas=None, *, all_schemas: bool = False, default_schema: str | None = None) -> dict:
    """F6 on the object list, before anything is counted: an explicit list of
    schemas, all non-system schemas (F3), or one default schema."""
    if all_schemas:
        keep = lambda sch: not _is_system(sch)
    elif schemas:
        wanted = set(schemas)
        keep = lambda sch: sch in wanted
    elif default_schema is not None:
        keep = lambda sch: sch == default_schema
    else:
        return dict(objects)
    return {k: v for k, v in objects.items() if keep(k[0])}


def profile(spark: SparkSession, objects: dict, *, count_tables: bool = True, include_views: bool = True,
            map_types: bool = False, schemas=None, all_schemas: bool = False,
            default_schema: str | None = None) -> DataFrame:
    """E3 in Spark form: per-object catalog entries (see `catalog_entries`).
    The schema scope is applied to the object list first, so out-of-scope
    tables are never counted."""
    objects = in_scope(objects, schemas, all_schemas=all_schemas, default_schema=default_schema)
    if not objects:
        raise ValueError("no objects in scope")
    tables, views, raw = system_tables(spark, objects)
    inv = inventory(tables, views)
    cols = normalise_columns(raw, keep=("SCHEMA_NAME", "OBJECT_NAME")) \
        .withColumnRenamed("SCHEMA_NAME", "schema").withColumnRenamed("OBJECT_NAME", "object")
    counts = counted_objects(spark, objects) if count_tables else None
    return catalog_entries(inv, cols, counts, include_views=include_views, map_types=map_types)


def catalog_columns(cat: DataFrame, schema: str, obj: str) -> DataFrame:
    """The normalised column metadata of one catalogued object (table or
    view), read from the catalog document."""
    from ..operators.nested import flatten_catalog
    flat = flatten_catalog(cat).where((F.col("schema") == schema) & (F.col("object") == obj))
    return flat.where(F.col("COLUMN_NAME").isNotNull()).drop("schema", "kind", "object", "row_count", "access_ok")


def conform_from_catalog(df: DataFrame, cat: DataFrame, schema: str, obj: str, **kw) -> DataFrame:
    """P1 driven by the catalog: cast `df` to the declared types the catalog
    holds for `schema.obj` (the Spark form of regenerating a CAST query per
    catalogued table). No column metadata is an error."""
    from ..operators.project import conform
    return conform(df, catalog_columns(cat, schema, obj), **kw)


def _is_system(name: str) -> bool:
    from ..fixed import SYSTEM_SCHEMA_NAMES, SYSTEM_SCHEMA_PREFIX
    upper = (name or "").upper()
    return upper.startswith(SYSTEM_SCHEMA_PREFIX) or upper in SYSTEM_SCHEMA_NAMES


def catalog_objects_from_session(spark: SparkSession, databases=None, *, all_databases: bool = False,
                                 default_database: str = "default", include_views: bool = True,
                                 include_temporary: bool = False, temporary_as: str = "view") -> dict:
    """The objects of the session catalog, in the form `profile` takes.

    Databases: all non-system ones (F3), an explicit list, or the default
    one (F6). Tables and views come from `spark.catalog`; an object that
    does not resolve is a table that is left out, or a view marked
    unreadable (the access check). Only metadata is listed here; the row
    counts run later as one job. Temporary views count as `temporary_as`
    (e.g. "table" for Parquet folders registered as views).
    """
    if all_databases:
        names = sorted(d.name for d in spark.catalog.listDatabases() if not _is_system(d.name))
    elif databases:
        names = list(databases)
    else:
        names = [default_database]
    objects = {}
    for db in names:
        for t in spark.catalog.listTables(db):
            if t.isTemporary and not include_temporary:
                continue
            if t.isTemporary:
                kind = temporary_as
            else:
                kind = "view" if (t.tableType or "").upper() == "VIEW" else "table"
            if kind == "view" and not include_views:
                continue
            qualified = t.name if t.isTemporary else f"`{db}`.`{t.name}`"
            try:
                df = spark.table(qualified)
                readable = True
            except Exception:
                if kind == "table":
                    continue
                df, readable = spark.range(0), False
            objects[(db, t.name)] = (kind, df, readable) if kind == "view" else (kind, df)
    return objects
