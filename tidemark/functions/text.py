"""Small column helpers used across operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import GUID_PATTERN


def col_or_null(df, name: str, dtype: str = "string") -> Column:
    """The named column, or a typed null when the frame does not have it."""
    return df[f"`{name}`"] if name in df.columns else F.lit(None).cast(dtype)


def first_non_empty(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols])


def truthy(c: Column, dtype: T.DataType) -> Column:
    """Python-style truth of a value: null, 0, false and '' are false."""
    if isinstance(dtype, T.BooleanType):
        out = c
    elif isinstance(dtype, T.NumericType):
        out = c != 0
    elif isinstance(dtype, T.NullType):
        out = F.lit(False)
    else:
        out = F.length(c.cast("string")) > 0
    return F.coalesce(out, F.lit(False))


def is_guid(c: Column) -> Column:
    """True for hyphenated 8-4-4-4-12 hex ids; null and anything else false."""
    return F.coalesce(c.rlike(GUID_PATTERN), F.lit(False))


def bounded_text(c: Column, length: int, on_long_text: str = "truncate") -> Column:
    """Text limited to `length` characters: cut it, keep it, or fail the job."""
    s = c.cast("string")
    if on_long_text == "truncate":
        return F.substring(s, 1, length)
    if on_long_text == "keep":
        return s
    if on_long_text == "error":
        return F.when(F.length(s) > length,
                      F.raise_error(F.concat(F.lit(f"text longer than {length}: "), s))).otherwise(s)
    raise ValueError(f"on_long_text must be truncate, keep or error, not {on_long_text!r}")
