"""The nested catalog as a JSON document (one line per schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_META = T.StructType([
    T.StructField("COLUMN_NAME", T.StringType()),
    T.StructField("DATA_TYPE", T.StringType()),
    T.StructField("CHARACTER_MAXIMUM_LENGTH", T.LongType()),
    T.StructField("NUMERIC_PRECISION", T.LongType()),
    T.StructField("NUMERIC_SCALE", T.LongType()),
    T.StructField("IS_NULLABLE", T.StringType()),
    T.StructField("ORDINAL_POSITION", T.LongType()),
])

FILE_COL = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])

OBJECT_ENTRY = T.StructType([
    T.StructField("columns", T.ArrayType(COLUMN_META)),
    T.StructField("row_count", T.LongType()),
    T.StructField("access_ok", T.BooleanType()),
    T.StructField("pyarrow_cols", T.ArrayType(FILE_COL)),
])

CATALOG_DOC = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), OBJECT_ENTRY)),
    T.StructField("views", T.MapType(T.StringType(), OBJECT_ENTRY)),
])


CATALOG_ENTRY = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("object", T.StringType()),
    T.StructField("entry", OBJECT_ENTRY),
])


def write_catalog(cat: DataFrame, path: str, generated_at: str | None = None) -> None:
    """The catalog as JSON lines, replacing the previous one.

    Per-object entries (schema, kind, object, entry) are written one line
    each, in parallel, with `generated_at`; a per-schema document (from
    `build_catalog`) is written one line per schema."""
    if "entry" in cat.columns and "generated_at" not in cat.columns:
        cat = cat.select(F.lit(generated_at).alias("generated_at"), "schema", "kind", "object", "entry")
    cat.write.mode("overwrite").json(path)


def read_catalog(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """Read a catalog back with its declared schema (no inference):
    per-object lines by default, or the per-schema document (`nested`)."""
    return spark.read.schema(CATALOG_DOC if nested else CATALOG_ENTRY).json(path)


DOCUMENT = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("schemas", T.MapType(T.StringType(), T.StructType([CATALOG_DOC["tables"], CATALOG_DOC["views"]]))),
])


def document_lines(entries: DataFrame, generated_at: str) -> DataFrame:
    """The lines of one nested JSON document (schema, tables and views,
    object), with the columns they are ordered by: `place, schema, section,
    object`. Every object is a line of its own, so no group holds a schema;
    whether a comma comes first follows from one minimum per section."""
    def name(c):
        text = F.to_json(F.array(c))
        return F.substr(text, F.lit(2), F.length(text) - 2)
    objects = entries.select("schema", "kind", "object", F.to_json("entry").alias("body"))
    first = objects.groupBy("schema", "kind").agg(F.min("object").alias("first"))
    schemas = objects.select("schema").distinct()
    top = schemas.agg(F.min("schema")).scalar()
    comma = lambda is_first: F.when(is_first, "").otherwise(",")
    lines = objects.join(first, ["schema", "kind"]).select(
        F.lit(1).alias("place"), "schema", F.when(F.col("kind") == "table", 1).otherwise(3).alias("section"), "object",
        F.concat(comma(F.col("object") == F.col("first")), name(F.col("object")), F.lit(": "), F.col("body")).alias("value"))
    marks = schemas.select("schema", F.explode(F.array(
        F.struct(F.lit(0).alias("section"), F.concat(comma(F.col("schema") == top), name(F.col("schema")), F.lit(': {"tables": {')).alias("value")),
        F.struct(F.lit(2).alias("section"), F.lit('}, "views": {').alias("value")),
        F.struct(F.lit(4).alias("section"), F.lit("}}").alias("value")))).alias("m"))
    marks = marks.select(F.lit(1).alias("place"), "schema", "m.section", F.lit("").alias("object"), "m.value")
    spark = entries.sparkSession
    ends = spark.createDataFrame([(0, "", 0, "", generated_at), (2, "", 0, "", None)],
                                 "place int, schema string, section int, object string, value string")
    ends = ends.withColumn("value", F.when(F.col("place") == 0, F.concat(F.lit('{"generated_at": '), name(F.col("value")), F.lit(', "schemas": {')))
                           .otherwise(F.lit("}}")))
    return lines.unionByName(marks).unionByName(ends)


def write_document(entries: DataFrame, path: str, generated_at: str) -> None:
    """One nested JSON document as text files that follow each other by
    name; together they are the document. A range sort orders the lines, so
    a schema of any size is written by many tasks."""
    (document_lines(entries, generated_at).orderBy("place", "schema", "section", "object").select("value")
     .write.mode("overwrite").text(path))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A nested document, one row per schema like `read_catalog(nested=True)`.
    JSON is one value, so the document is put together as one text, which
    bounds it by the size of a row; the per-object form has no such bound."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value")
    text = files.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "value"))), lambda x: x["value"]), "").alias("text"))
    d = text.select(F.from_json("text", DOCUMENT).alias("d"))
    return d.select("d.generated_at", F.explode("d.schemas").alias("schema", "s")).select("generated_at", "schema", "s.tables", "s.views")
