"""Aggregations: table counts (A1), next watermark (A2), largest tuple (A3),
column maximum (A4), duplicate keys (A5), catalog totals (A7), run outcome
(A8) and listing counts (A9). All are partial + final hash aggregates."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import PK_PREFIX, WM_PREFIX
from .filters import mark_range, typed_lit


def table_counts(spark: SparkSession, tables: dict) -> DataFrame:
    """A1: `COUNT(*)` of every table in one job (a union of global
    aggregates). A table that cannot be read gets a null (unknown) count.

    `tables` maps a name to a DataFrame or to a zero-argument callable that
    builds one (so a missing source fails only its own entry).
    """
    parts = []
    for name in sorted(tables):
        src = tables[name]
        try:
            df = src() if callable(src) and not isinstance(src, DataFrame) else src
            part = df.agg(F.count(F.lit(1)).alias("row_count"))
        except Exception:
            part = spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        parts.append(part.select(F.lit(name).alias("table_name"), F.col("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def watermark_after(df: DataFrame, mark: str, last=None, high=None) -> DataFrame:
    """A2 as a one-row frame: the largest mark above `last` (and at most
    `high`), or `last` when there is none."""
    dtype = df.schema[mark].dataType
    fallback = typed_lit(last, dtype)
    return df.where(mark_range(df[mark], last, high, dtype)).agg(
        F.coalesce(F.max(mark), fallback).alias("watermark"))


def next_watermark(df: DataFrame, mark: str, last=None, high=None):
    """A2: the new high-water mark as a Python value (one scalar)."""
    return watermark_after(df, mark, last, high).first()["watermark"]


def _suffix(name: str) -> int:
    try:
        return int(name[len(WM_PREFIX):])
    except ValueError:
        return 0


def wm_columns(df: DataFrame) -> list[str]:
    """Columns whose names start with WM (any case), in order of their
    numeric suffix (non-numeric counts as 0; ties keep column order)."""
    names = [c for c in df.columns if c.upper().startswith(WM_PREFIX)]
    return sorted(names, key=_suffix)


def max_tuple(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: the lexicographically largest tuple over `cols` (default: the WM
    columns) as a one-row frame; all null when the input is empty. Nulls sort
    lowest within each position."""
    cols = cols or wm_columns(df)
    if not cols:
        raise ValueError("no watermark columns")
    best = F.max(F.struct(*[df[f"`{c}`"].alias(c) for c in cols])).alias("t")
    return df.agg(best).select(*[F.col("t")[c].alias(c) for c in cols])


def max_tuple_values(df: DataFrame, cols: list[str] | None = None) -> tuple | None:
    """A3 as Python values, column by column: the largest first value, then
    the largest second value among rows with that first value (null-safe),
    and so on. Equal to `max_tuple` (nulls lowest), but each step reads one
    column and the equality filters reach the Parquet scan, so on a large
    previous snapshot only the row groups that can hold the maximum are read
    after the first step. None when the input is empty."""
    cols = cols or wm_columns(df)
    if not cols:
        raise ValueError("no watermark columns")
    scope = df
    values = []
    for i, c in enumerate(cols):
        if i == 0 and scope.limit(1).count() == 0:
            return None
        col = df[f"`{c}`"]
        v = scope.agg(F.max(col)).first()[0]
        values.append(v)
        scope = scope.where(col.eqNullSafe(typed_lit(v, df.schema[c].dataType)))
    return tuple(values)


def max_column(df: DataFrame, col: str, alias: str = "max_value") -> DataFrame:
    """A4: maximum of one column, missing values (null, NaN) skipped; null
    when nothing is left."""
    c = df[f"`{col}`"]
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)
    return df.agg(F.max(c).alias(alias))


def pk_columns(df: DataFrame) -> list[str]:
    """Key columns discovered by name: those starting with PK (any case)."""
    return [c for c in df.columns if c.upper().startswith(PK_PREFIX)]


def duplicate_keys(df: DataFrame, pk: list[str] | None = None) -> DataFrame:
    """A5: every key value occurring more than once, with its count `n`.
    Null keys group as equal. Map-side partial counts keep a hot key cheap."""
    pk = pk if pk is not None else pk_columns(df)
    missing = [c for c in pk if c not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not among {df.columns}")
    return (df.groupBy(*[df[f"`{c}`"] for c in pk]).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def key_summary(df: DataFrame, pk: list[str], name: str) -> DataFrame:
    """A5 as a profile: distinct keys, keys occurring more than once, and
    the rows carrying those keys, in one grouped aggregate (map-side partial
    counts, so a hot key stays cheap)."""
    per_key = df.groupBy(*[df[f"`{c}`"] for c in pk]).agg(F.count(F.lit(1)).alias("n"))
    dup = F.col("n") > 1
    return per_key.agg(
        F.count(F.lit(1)).alias("key_count"),
        F.count(F.when(dup, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("long").alias("rows_in_duplicates"),
    ).select(F.lit(name).alias("table_name"), "key_count", "duplicate_keys", "rows_in_duplicates")


def assert_unique(df: DataFrame, pk: list[str] | None = None, examples: int = 5) -> None:
    """A5 as a check: raise with up to `examples` duplicate keys; no key
    columns means no check."""
    pk = pk if pk is not None else pk_columns(df)
    if not pk:
        return
    dups = duplicate_keys(df, pk).limit(examples).collect()
    if dups:
        shown = [tuple(r[c] for c in pk) for r in dups]
        raise ValueError(f"key ({', '.join(pk)}) repeats, for example {shown}")


def catalog_totals(entries: DataFrame, schema_col: str = "schema", kind_col: str = "kind") -> DataFrame:
    """Number of schemas, tables and views in a catalog."""
    return entries.agg(
        F.countDistinct(schema_col).alias("schemas"),
        F.count(F.when(F.col(kind_col) == "table", 1)).alias("tables"),
        F.count(F.when(F.col(kind_col) == "view", 1)).alias("views"))


def run_outcome(run_log: DataFrame) -> DataFrame:
    """Any failure fails the whole run; totals of units and rows."""
    failed = F.col("error").isNotNull()
    return run_log.agg(
        F.count(F.lit(1)).alias("units"),
        F.count(F.when(failed, 1)).alias("failed"),
        F.coalesce(F.bool_or(failed), F.lit(False)).alias("any_failed"),
        F.coalesce(F.sum(F.when(~failed & (F.col("rows") > 0), F.col("rows"))), F.lit(0)).cast("long").alias("rows"))


def count_by(df: DataFrame, *cols: str, alias: str = "n") -> DataFrame:
    """Rows per group (e.g. workspaces per root domain)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(alias))
