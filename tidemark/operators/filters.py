"""Filters: watermark range (F1), non-system schemas (F3), non-empty tables
(F4), tag match (F5), schema scope (F6). All are plain predicates, so they
reach the Parquet scan as pushed filters where the column allows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import SYSTEM_SCHEMA_NAMES, SYSTEM_SCHEMA_PREFIX


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def typed_lit(value, dtype: T.DataType | None = None) -> Column:
    """A literal of the column's own type. A wall-clock timestamp
    (timestamp_ntz) is built from its text, so no time zone is applied on
    the way (a Python datetime literal would be read in a zone)."""
    if dtype is None:
        return F.lit(value)
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def mark_range(mark, low=None, high=None, dtype: T.DataType | None = None, floor=None) -> Column:
    """`low < mark <= high`: rows at or below the saved mark are never read
    again. Without a saved low every row with a mark is in range; `floor`
    (for example 0) then gives a lower bound where a source needs one.
    `dtype` is the mark's type, so the bounds are literals of that type."""
    m = _as_col(mark)
    low = floor if low is None else low
    cond = m.isNotNull() if low is None else m > typed_lit(low, dtype)
    if high is not None:
        cond = cond & (m <= typed_lit(high, dtype))
    return cond


def since(df: DataFrame, mark: str, low=None, high=None) -> DataFrame:
    """rows strictly above the saved watermark (and at most `high`)."""
    return df.where(mark_range(df[mark], low, high, df.schema[mark].dataType))


def non_system_schemas(schemas: DataFrame, col: str = "SCHEMA_NAME") -> DataFrame:
    """drop the system schemas (names and prefix in `fixed`), any case."""
    name = F.upper(F.col(col))
    return (schemas.where(~name.startswith(SYSTEM_SCHEMA_PREFIX) & ~name.isin(*SYSTEM_SCHEMA_NAMES))
            .orderBy(col))


def non_empty(tables: DataFrame, count_col: str = "row_count", counted: bool = True) -> DataFrame:
    """counted tables with rows; an unknown count (failed) drops the
    table. Without counting every table is kept."""
    if not counted:
        return tables
    return tables.where(F.col(count_col) > 0)


def any_tag(tags: Column, candidates) -> Column:
    """True when any tag's id or displayName equals any candidate; missing or
    null tags never match."""
    cands = [F.lit(c) for c in candidates]
    return F.coalesce(F.exists(tags, lambda t: t["id"].isin(*cands) | t["displayName"].isin(*cands)),
                      F.lit(False))


def with_any_tag(reports: DataFrame, candidates, tags_col: str = "tags") -> DataFrame:
    """keep reports carrying any candidate tag; no candidates = no filter."""
    candidates = [c for c in (candidates or [])]
    if not candidates:
        return reports
    return reports.where(any_tag(F.col(tags_col), candidates))


def in_schemas(meta: DataFrame, col: str = "SCHEMA_NAME", schemas=None, *, all_schemas: bool = False,
               default_schema: str | None = None) -> DataFrame:
    """objects of all non-system schemas, of an explicit list, or of the
    one default schema."""
    name = F.col(col)
    if all_schemas:
        upper = F.upper(name)
        return meta.where(~upper.startswith(SYSTEM_SCHEMA_PREFIX) & ~upper.isin(*SYSTEM_SCHEMA_NAMES))
    if schemas:
        return meta.where(name.isin(*list(schemas)))
    if default_schema is None:
        raise ValueError("give schemas, all_schemas=True or a default_schema")
    return meta.where(name == F.lit(default_schema))
