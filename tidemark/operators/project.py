"""Projections: cast conform (P1), envelope (P4), metadata normaliser.
The row marker (P5) lives with the change-row join in `joins.py`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DELETED_COL, NULLABLE_NO, NULLABLE_YES, OP_COL, OP_UPSERT, WATERMARK_COL
from ..functions.text import bounded_text, col_or_null, first_non_empty, truthy
from ..functions.types import cast_type, spark_type
from ..sources.catalog_doc import COLUMN_META


def _spec_frame(df: DataFrame, column_spec) -> DataFrame:
    if isinstance(column_spec, DataFrame):
        return column_spec
    rows = [{f.name: d.get(f.name) for f in COLUMN_META} for d in column_spec]
    return df.sparkSession.createDataFrame(rows, schema=COLUMN_META)


def column_casts(spec: DataFrame) -> list[tuple[str, str | None, bool]]:
    """(name, cast type, has a declared length) per described column in
    metadata order; columns without a name are skipped. Nested and boolean
    columns, for which there is no cast rule, have no cast type. One row per
    column of one table is collected."""
    if "cast_type" not in spec.columns:
        spec = spec.withColumn("cast_type", cast_type(
            col_or_null(spec, "DATA_TYPE"), col_or_null(spec, "NUMERIC_PRECISION", "long"),
            col_or_null(spec, "NUMERIC_SCALE", "long"), col_or_null(spec, "CHARACTER_MAXIMUM_LENGTH", "long")))
    order = col_or_null(spec, "ORDINAL_POSITION", "long")
    named = spec.where(F.length(F.col("COLUMN_NAME")) > 0)
    length = col_or_null(spec, "CHARACTER_MAXIMUM_LENGTH", "long")
    declared_type = F.upper(F.coalesce(col_or_null(spec, "DATA_TYPE"), F.lit("")))
    as_is = declared_type.contains("<") | (declared_type == "BOOLEAN")
    rows = named.select("COLUMN_NAME", F.when(~as_is, F.col("cast_type")).alias("cast_type"), order.alias("_pos"),
                        (F.coalesce(length, F.lit(0)) > 0).alias("_bounded")).collect()
    # A table's width is small: order it here rather than with a Spark sort.
    rows.sort(key=lambda r: (r["_pos"] is None, r["_pos"] if r["_pos"] is not None else 0))
    return [(r["COLUMN_NAME"], r["cast_type"], r["_bounded"]) for r in rows]


def conform_column(c: Column, cast_type_name: str | None, on_error: str = "raise",
                   on_long_text: str = "error", bounded: bool = True) -> Column:
    """One column cast to its type. Only a declared (`bounded`) length limits
    text: the length in the name of an undeclared type is a default."""
    if cast_type_name is None:
        return c
    dtype, max_len = spark_type(cast_type_name)
    max_len = max_len if bounded else None
    if on_error == "raise":
        out = c.cast(dtype)
    elif on_error == "null":
        out = c.try_cast(dtype)
    else:
        raise ValueError(f"on_error must be raise or null, not {on_error!r}")
    if max_len is not None:
        out = bounded_text(out, max_len, on_long_text)
    return out


def conform(df: DataFrame, column_spec, on_error: str = "raise", on_long_text: str = "error") -> DataFrame:
    """Every described column cast to its declared type, same name, in
    metadata order. Text longer than its declared length fails the job;
    `on_long_text="truncate"` cuts it and `"keep"` keeps it. Text without a
    declared length, and nested and boolean columns, stay whole.
    `on_error="null"` turns bad values into null instead of failing the job.

    `column_spec` is a metadata DataFrame (normalised as by
    `normalise_columns`, optionally with a `cast_type` column) or a list of
    such dicts.
    """
    casts = column_casts(_spec_frame(df, column_spec))
    if not casts:
        raise ValueError("no column metadata: refusing to build a projection without declared columns")
    return df.select(*[conform_column(df[f"`{name}`"], t, on_error, on_long_text, bounded).alias(name)
                       for name, t, bounded in casts])


def envelope(df: DataFrame, version=0, op: str = OP_UPSERT, deleted: int = 0) -> DataFrame:
    """Full-refresh envelope columns first, then the row.

    `version` may be a literal or a Column; pass a fixed value rather than
    `current_timestamp()` when results must be reproducible.
    """
    v = version if isinstance(version, Column) else F.lit(version)
    return df.select(v.alias(WATERMARK_COL), F.lit(op).alias(OP_COL), F.lit(deleted).alias(DELETED_COL),
                     *[df[f"`{c}`"] for c in df.columns])


def normalise_columns(meta: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw column metadata (whatever alias fields the source exposes) to
    the seven normalised fields, keeping the `keep` columns in front."""
    name = first_non_empty(col_or_null(meta, "COLUMN_NAME"), col_or_null(meta, "COLUMN"),
                           col_or_null(meta, "FIELD_NAME"))
    dtype = first_non_empty(col_or_null(meta, "SQL_TYPE_NAME"), col_or_null(meta, "DATA_TYPE"),
                            col_or_null(meta, "DATA_TYPE_NAME"), col_or_null(meta, "TYPE_NAME"))
    nullable_flag = (truthy(meta["NULLABLE"], meta.schema["NULLABLE"].dataType)
                     if "NULLABLE" in meta.columns else F.lit(False))
    given = col_or_null(meta, "IS_NULLABLE")
    is_nullable = F.when(given.isNotNull(), given.cast("string")).when(nullable_flag, F.lit(NULLABLE_YES)) \
        .otherwise(F.lit(NULLABLE_NO))
    return meta.select(
        *[meta[f"`{k}`"] for k in keep],
        name.alias("COLUMN_NAME"),
        dtype.alias("DATA_TYPE"),
        col_or_null(meta, "LENGTH", "long").cast("long").alias("CHARACTER_MAXIMUM_LENGTH"),
        col_or_null(meta, "PRECISION", "long").cast("long").alias("NUMERIC_PRECISION"),
        col_or_null(meta, "SCALE", "long").cast("long").alias("NUMERIC_SCALE"),
        is_nullable.alias("IS_NULLABLE"),
        col_or_null(meta, "POSITION", "long").cast("long").alias("ORDINAL_POSITION"),
    )
