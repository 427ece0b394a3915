"""Any SELECT over registered views, with bound parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import paths

_WM_SLOT = re.compile(r"\{WM(\d+)\}")


def query_source(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """Run one statement; `args` binds named (`:name`) or positional (`?`)
    parameters as typed literals, so no value is spliced into the text.

    Spark's parser rejects text with more than one statement.
    """
    if args:
        return spark.sql(sql, args=args)
    return spark.sql(sql)


def bind_placeholders(sql: str) -> str:
    """Turn text slots into named parameters: `{WM1}`, `{WM2}`, ... become
    `:wm1`, `:wm2`, ... and `{WATERMARK}` becomes `:low`, so values are bound
    as typed literals instead of being spliced into the text."""
    return _WM_SLOT.sub(lambda m: f":wm{m.group(1)}", sql).replace("{WATERMARK}", ":low")


def statements_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """Top-level `*.sql` files of a folder (any case of the suffix), skipping
    names that start with `_` or end with `~`, as {file stem: statement}."""
    out = {}
    for name in paths.list_files(spark, folder):
        if name.startswith("_") or name.endswith("~") or not name.lower().endswith(".sql"):
            continue
        text = paths.read_text(spark, f"{folder.rstrip('/')}/{name}") or ""
        out[name[:-4]] = bind_placeholders(text.strip())
    return out


def bindable(value, type_name: str | None = None):
    """A parameter value that binds without a time-zone shift: a wall-clock
    timestamp (timestamp_ntz) is passed as its text, which Spark coerces to
    the compared column's type; other values pass as they are."""
    import datetime as dt
    if type_name == "timestamp_ntz" and isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return value
