"""Declared database types → cast types (P2), file types (P3), Spark types.

The rules are evaluated as Spark expressions over column-metadata frames, so a
catalog of any size is typed in parallel.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import (DEFAULT_CHAR_LENGTH, DEFAULT_DECIMAL_PRECISION, DEFAULT_DECIMAL_SCALE,
                     DEFAULT_VARCHAR_LENGTH, FALLBACK_CAST_TYPE, LARGE_STRING_FROM_LENGTH)


def _has(dt: Column, *words: str) -> Column:
    out = None
    for w in words:
        term = dt.contains(w)
        out = term if out is None else (out | term)
    return out


def _or_default(c: Column, default: int) -> Column:
    # A missing or zero value falls back to the default.
    return F.when(c.isNull() | (c == 0), F.lit(default)).otherwise(c).cast("long").cast("string")


def cast_type(type_name: Column, precision: Column, scale: Column, char_len: Column) -> Column:
    """The cast type for one declared column type (first matching rule)."""
    dt = F.upper(F.coalesce(type_name, F.lit("")))
    p = _or_default(precision, DEFAULT_DECIMAL_PRECISION)
    s = _or_default(scale, DEFAULT_DECIMAL_SCALE)
    return (
        F.when(dt.contains("DECIMAL") | dt.startswith("NUMERIC"), F.concat(F.lit("DECIMAL("), p, F.lit(","), s, F.lit(")")))
        .when(dt.contains("BIGINT"), F.lit("BIGINT"))
        .when(dt.contains("SMALLINT"), F.lit("SMALLINT"))
        .when(dt.contains("TINYINT"), F.lit("TINYINT"))
        .when(dt.contains("INT"), F.lit("INTEGER"))
        .when(_has(dt, "DOUBLE", "REAL", "FLOAT"), F.lit("DOUBLE"))
        .when(_has(dt, "SECONDDATE", "TIMESTAMP"), F.lit("TIMESTAMP"))
        .when(dt.contains("DATE"), F.lit("DATE"))
        .when(_has(dt, "BINARY", "BLOB"), F.lit("BLOB"))
        .when(dt.contains("NVARCHAR"), F.concat(F.lit("NVARCHAR("), _or_default(char_len, DEFAULT_VARCHAR_LENGTH), F.lit(")")))
        .when(dt.contains("VARCHAR"), F.concat(F.lit("VARCHAR("), _or_default(char_len, DEFAULT_VARCHAR_LENGTH), F.lit(")")))
        .when(dt.contains("CHAR"), F.concat(F.lit("CHAR("), _or_default(char_len, DEFAULT_CHAR_LENGTH), F.lit(")")))
        .otherwise(F.lit(FALLBACK_CAST_TYPE))
    )


def file_type(type_name: Column, precision: Column, scale: Column, char_len: Column) -> Column:
    """The Parquet/Arrow file type for one declared column type."""
    dt = F.upper(F.coalesce(type_name, F.lit("")))
    p = _or_default(precision, DEFAULT_DECIMAL_PRECISION)
    s = _or_default(scale, DEFAULT_DECIMAL_SCALE)
    short_text = char_len.isNotNull() & (char_len != 0) & (char_len < LARGE_STRING_FROM_LENGTH)
    return (
        F.when(dt.contains("DECIMAL") | dt.startswith("NUMERIC"), F.concat(F.lit("decimal128("), p, F.lit(","), s, F.lit(")")))
        .when(dt.contains("INT"), F.lit("int64"))
        .when(_has(dt, "DOUBLE", "REAL", "FLOAT"), F.lit("float64"))
        .when(_has(dt, "TIMESTAMP", "DATE"), F.lit("timestamp"))
        .when(_has(dt, "BINARY", "BLOB"), F.lit("binary"))
        .when(short_text, F.lit("string"))
        .otherwise(F.lit("large_string"))
    )


_DECIMAL = re.compile(r"^DECIMAL\((\d+),(\d+)\)$")
_TEXT = re.compile(r"^(NVARCHAR|VARCHAR|CHAR)\((\d+)\)$")

_SIMPLE = {
    "BIGINT": T.LongType(),
    "SMALLINT": T.ShortType(),
    # A declared TINYINT may be unsigned (0..255), which ByteType cannot hold.
    "TINYINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "BLOB": T.BinaryType(),
}


def spark_type(cast_type_name: str) -> tuple[T.DataType, int | None]:
    """A P2 cast type as (Spark type, maximum text length or None)."""
    name = cast_type_name.strip().upper()
    if name in _SIMPLE:
        return _SIMPLE[name], None
    m = _DECIMAL.match(name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2))), None
    m = _TEXT.match(name)
    if m:
        return T.StringType(), int(m.group(2))
    raise ValueError(f"unknown cast type {cast_type_name!r}")
