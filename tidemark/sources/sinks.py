"""Sinks: snapshot (S4), part files (S5) and change-feed sequences.

All three stage the output next to the target, count rows with an
`Observation` while writing (no second scan), and publish by a folder swap:
a failed or empty write leaves the old data untouched.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..fixed import SEQUENCE_DIGITS
from . import paths
from .feed_log import run_dir, sequence_dir


def _hidden(target: str, kind: str) -> tuple[str, str]:
    """Folder beside the target and name prefix for its staged (`new`) or
    replaced (`old`) data. Readers skip names that start with an underscore
    and hold no equals sign."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return parent, f"_{kind}-{name.replace('=', '~')}--"


def recover(spark, target: str) -> None:
    """Clears what a killed writer of this target left: if the target is gone
    its replaced data goes back in place; staged data is dropped."""
    for kind in ("old", "new"):
        parent, prefix = _hidden(target, kind)
        for name in paths.list_dirs(spark, parent):
            if name.startswith(prefix):
                if kind == "old" and not paths.exists(spark, target):
                    paths.rename(spark, f"{parent}/{name}", target)
                else:
                    paths.delete(spark, f"{parent}/{name}")


def _publish(spark, staging: str, target: str) -> None:
    if not paths.exists(spark, target):
        paths.rename(spark, staging, target)
        return
    parent, prefix = _hidden(target, "old")
    old = f"{parent}/{prefix}{uuid.uuid4().hex[:8]}"
    paths.rename(spark, target, old)
    try:
        paths.rename(spark, staging, target)
    except Exception:
        paths.rename(spark, old, target)
        raise
    paths.delete(spark, old)


def staged_write(df: DataFrame, target: str, *, sort_by=None, sort_within=None, options: dict | None = None,
                 validate: Callable[[DataFrame], None] | None = None, keep_empty: bool = False,
                 metrics: dict | None = None, drop: tuple = (), stored: bool = False) -> int:
    """Write `df` as Parquet to a hidden sibling folder, then swap it in. One
    writer at a time may write a target; what a killed one left is cleared.

    Returns the number of rows written. With zero rows nothing is published
    (unless `keep_empty`). `validate` sees the staged data before the swap and
    may raise to discard it. `sort_by` gives a global order (range shuffle);
    `sort_within` sorts each output file only (no shuffle). `metrics` names
    extra aggregate Columns observed during the same write (their values are
    filled into the dict); `drop` lists helper columns removed after
    observing and sorting. `stored` says that `df` only reads stored rows, so
    that a global sort need not keep its input.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    recover(spark, target)
    parent, prefix = _hidden(target, "new")
    staging = f"{parent}/{prefix}{uuid.uuid4().hex[:12]}"
    rows = _write(df, staging, sort_by=sort_by, sort_within=sort_within, options=options, validate=validate, metrics=metrics,
                  drop=drop, stored=stored)
    if rows == 0 and not keep_empty:
        paths.delete(spark, staging)
        return 0
    _publish(spark, staging, target)
    return rows


def _write(df: DataFrame, folder: str, *, sort_by=None, sort_within=None, options: dict | None = None,
           validate: Callable[[DataFrame], None] | None = None, metrics: dict | None = None, drop: tuple = (),
           stored: bool = False) -> int:
    """The write of `staged_write` into a folder that nobody reads yet; a
    failed one is deleted."""
    spark = df.sparkSession
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    extra = [c.alias(k) for k, c in (metrics or {}).items()]
    out = df
    cached = None
    if sort_by:
        # A global sort first samples its input in a separate job; keep the
        # input so it is computed once (spills to disk when large).
        if not stored:
            cached = out = out.persist(StorageLevel.MEMORY_AND_DISK)
        out = out.orderBy(*sort_by)
    elif sort_within:
        out = out.sortWithinPartitions(*sort_within)
    # Observed above the sort: a global sort first samples its input in a
    # separate job, which would otherwise be counted too.
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)
    if drop:
        out = out.drop(*drop)
    writer = out.write.mode("errorifexists").option("compression", "snappy")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    try:
        writer.parquet(folder)
        observed = obs.get
        rows = int(observed["rows"])
        if metrics is not None:
            for k in metrics:
                metrics[k] = observed.get(k)
        if validate is not None and rows > 0:
            validate(spark.read.parquet(folder))
    except Exception:
        paths.delete(spark, folder)
        raise
    finally:
        if cached is not None:
            cached.unpersist()
    return rows


def write_snapshot(df: DataFrame, path: str, *, sort_by=None,
                   validate: Callable[[DataFrame], None] | None = None) -> int:
    """Atomic replace of a snapshot folder; nothing written for zero rows."""
    return staged_write(df, path, sort_by=sort_by, validate=validate)


def write_parts(df: DataFrame, path: str, rows_per_file: int) -> int:
    """Parquet files of at most `rows_per_file` rows each."""
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be positive")
    return staged_write(df, path, options={"maxRecordsPerFile": str(rows_per_file)})


def write_change(df: DataFrame, root: str, table: str, seq: int, *, sort_by=None, sort_within=None,
                 metrics: dict | None = None, drop: tuple = (), digits: int = SEQUENCE_DIGITS, stored: bool = False) -> int:
    """Write one change set as `<root>/<table>/seq=<zero-padded seq>`.

    Re-running the same sequence replaces that one folder, so a retried run
    is idempotent. Zero rows publish nothing.
    """
    return staged_write(df, sequence_dir(root, table, seq, digits), sort_by=sort_by, sort_within=sort_within,
                        metrics=metrics, drop=drop, stored=stored)


def write_run(df: DataFrame, root: str, table: str, seq: int, *, sort_by=None, sort_within=None, metrics: dict | None = None,
              drop: tuple = (), stored: bool = False) -> tuple[int, str | None]:
    """S6 with a commit log: write one change set into a folder of its own and
    return its rows and its run id (none for zero rows, which leave nothing).
    `feed_log.commit` publishes it; until then no reader sees it."""
    run = uuid.uuid4().hex[:12]
    rows = 0
    try:
        rows = _write(df, run_dir(root, table, seq, run), sort_by=sort_by, sort_within=sort_within, metrics=metrics, drop=drop,
                      stored=stored)
    finally:
        if rows == 0:
            discard_run(df.sparkSession, root, table, seq, run)
    return (rows, run) if rows else (0, None)


def discard_run(spark, root: str, table: str, seq: int, run: str) -> None:
    """Deletes what a run wrote that will not be published."""
    paths.delete(spark, run_dir(root, table, seq, run))
    paths.delete_empty(spark, sequence_dir(root, table, seq))
