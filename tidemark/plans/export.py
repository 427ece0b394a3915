"""Incremental snapshot export (T4), folder of queries (T5), run log.

An export runs one SQL statement whose `:wm1, :wm2, ...` parameters are bound
to the largest WM tuple of the previous output, writes the result as a new
snapshot (staged, checked for duplicate keys, then swapped in) and reports the
rows written from the write itself.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..fixed import ELAPSED_DECIMALS
from ..operators.aggregates import assert_unique, max_tuple_values, pk_columns, wm_columns
from ..sources import paths
from ..sources.sinks import write_snapshot
from ..sources.sql import bindable, query_source, statements_in
from .units import run_units

RUN_LOG = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])


@dataclass
class ExportResult:
    name: str
    rows: int = 0
    elapsed: float = 0.0
    error: str | None = None
    marks: tuple | None = None

    def record(self) -> tuple:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat() + "Z"
        return (self.name, int(self.rows), round(self.elapsed, ELAPSED_DECIMALS), self.error, now)


def previous_marks(spark: SparkSession, target: str, with_types: bool = False):
    """F2 input: the largest WM tuple of the previous output, or None (with
    `with_types`, also the type names of the WM columns)."""
    if not paths.has_data_files(spark, target):
        return (None, None) if with_types else None
    prev = spark.read.parquet(target)
    cols = wm_columns(prev)
    row = max_tuple_values(prev, cols) if cols else None
    if row is None or all(v is None for v in row):
        return (None, None) if with_types else None
    types = tuple(prev.schema[c].dataType.simpleString() for c in cols)
    return (tuple(row), types) if with_types else tuple(row)


_SLOT = re.compile(r":wm(\d+)\b")


def mark_args(marks: tuple | None, types: tuple | None = None, sql: str | None = None) -> dict:
    """Named parameters wm1, wm2, ... for a WM tuple, bound as literals
    (wall-clock timestamps as text, so no time zone shifts them). A slot of
    the statement beyond the tuple's length is bound to NULL."""
    if marks is None:
        return {}
    types = types or (None,) * len(marks)
    args = {f"wm{i}": bindable(v, t) for i, (v, t) in enumerate(zip(marks, types), start=1)}
    for n in sorted({int(m) for m in _SLOT.findall(sql or "")}):
        args.setdefault(f"wm{n}", None)
    return args


def incremental_query(spark: SparkSession, sql: str, target: str, initial: tuple | None = None,
                      args: dict | None = None) -> tuple[DataFrame, tuple | None]:
    """the statement with `:wmN` bound to the previous output's largest
    tuple (or `initial` on the first run)."""
    prev, types = previous_marks(spark, target, with_types=True)
    marks = prev if prev is not None else initial
    bound = {**mark_args(marks, types if prev is not None else None, sql), **(args or {})}
    return query_source(spark, sql, bound or None), marks


def export(spark: SparkSession, name: str, sql: str, target: str, *, initial: tuple | None = None,
           args: dict | None = None, pk: list[str] | None = None) -> ExportResult:
    """T4: one incremental snapshot export; errors are reported in the result."""
    res = ExportResult(name=name)
    start = time.perf_counter()
    try:
        df, res.marks = incremental_query(spark, sql, target, initial, args)
        keys = pk if pk is not None else pk_columns(df)
        missing = [c for c in keys if c not in df.columns]
        if missing:
            raise ValueError(f"missing key column {missing[0]!r} in query result")
        check = (lambda staged: assert_unique(staged.select(*keys), keys)) if keys else None
        res.rows = write_snapshot(df, target, validate=check)
    except Exception as exc:
        res.error = f"{type(exc).__name__}: {exc}"
    finally:
        res.elapsed = time.perf_counter() - start
    return res


def write_metadata(spark: SparkSession, out_dir: str, res: ExportResult) -> None:
    """The run record of one export as `<out_dir>/<name>.metadata.json`, next
    to its output, for callers that inspect results without reading Parquet."""
    rec = dict(zip(RUN_LOG.fieldNames(), res.record()))
    paths.write_text(spark, f"{out_dir}/{res.name}.metadata.json", json.dumps(rec, indent=2))


def export_all(spark: SparkSession, statements: dict[str, str], out_dir: str, *, initial: dict | tuple | None = None,
               parallel: int = 1, **kw) -> list[ExportResult]:
    """T5: every named statement independently, up to `parallel` at a time; a
    failure does not stop the rest. `initial` is the first run's tuple, one for
    all or by statement name. Each run, in name order, is appended to the run
    log and leaves a metadata document next to its output."""
    out_dir = out_dir.rstrip("/")
    unknown = set(initial) - set(statements) if isinstance(initial, dict) else ()
    if unknown:
        raise ValueError(f"initial marks for {sorted(unknown)}, but the statements are {sorted(statements)}")

    def unit(name: str) -> ExportResult:
        first = initial.get(name) if isinstance(initial, dict) else initial
        res = export(spark, name, statements[name], f"{out_dir}/{name}", initial=first, **kw)
        write_metadata(spark, out_dir, res)
        return res

    results = run_units(spark, [partial(unit, n) for n in sorted(statements)], parallel)
    append_run_log(spark, f"{out_dir}/_runs", results)
    return results


def read_initial_marks(spark: SparkSession, folder: str) -> dict:
    """First tuples of a folder's statements: its `initial.json`, a list of
    values by statement name (see `typed_marks`); none if there is no file."""
    text = paths.read_text(spark, f"{folder.rstrip('/')}/initial.json")
    return {name: typed_marks(values) for name, values in json.loads(text).items()} if text else {}


def typed_marks(values: list) -> tuple:
    """Marks as they come from text or JSON: numbers and null as they are,
    text that reads as an ISO date or time as that, other text as text."""
    def typed(v):
        if isinstance(v, str):
            for kind in (dt.date, dt.datetime):
                try:
                    return kind.fromisoformat(v)
                except ValueError:
                    pass
        return v
    return tuple(typed(v) for v in values)


def export_folder(spark: SparkSession, folder: str, out_dir: str, names=None, *, initial: dict | None = None,
                  **kw) -> list[ExportResult]:
    """T5 over the `*.sql` files of a folder (see `statements_in`); `names`
    picks some of them (an unknown name is an error). First tuples come from
    `initial` and, for other statements, from the folder's `initial.json`."""
    statements = statements_in(spark, folder)
    marks = {n: m for n, m in read_initial_marks(spark, folder).items() if n in statements}
    marks.update(initial or {})
    if names:
        unknown = [n for n in names if n not in statements]
        if unknown:
            raise ValueError(f"query {unknown[0]!r} not found in {folder}")
        statements = {n: statements[n] for n in names}
        marks = {n: m for n, m in marks.items() if n in statements}
    return export_all(spark, statements, out_dir, initial=marks, **kw)


def run_log_frame(spark: SparkSession, results) -> DataFrame:
    return spark.createDataFrame([r.record() for r in results], RUN_LOG)


def append_run_log(spark: SparkSession, path: str, results) -> None:
    """Failures are logged too (error set, rows 0)."""
    if results:
        run_log_frame(spark, results).coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
