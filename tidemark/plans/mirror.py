"""Change-feed mirror (T1), its state (T2) and empty runs.

A run fixes the upper mark `high` first, reads delta requests with
`last < mark <= high`, writes the change set as sequence `last_sequence + 1`
into a folder of its own and publishes it together with the new state in one
step (see `sources.feed_log`). A failed run leaves the state alone, and so
does one that another writer overtook: nothing of it is read, and the retry
writes the same sequence again. A run with no rows publishes nothing and keeps
the sequence.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from dataclasses import dataclass, field
from decimal import Decimal
from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import next_watermark
from ..operators.filters import mark_range
from ..operators.joins import MARK, TIE, change_order, change_rows, delta_key_bounds
from ..operators.project import envelope
from ..session import scratch_dir
from ..sources import feed_log, paths
from ..sources.feed_log import state_dir
from ..sources.sinks import discard_run, write_run
from ..sources.sql import bindable
from .units import run_units

STATE_FIELDS = ("name", "last_sequence", "last_watermark", "watermark_type", "watermark_column", "mode",
                "last_run_utc")


@dataclass
class MirrorSpec:
    """What one mirrored table needs.

    `snapshot` builds the snapshot rows (full refresh source); `delta` builds
    the delta request table, whose `delta_key` points at the snapshot's
    `snap_key` and whose `mark` rises with every request.
    """
    name: str
    snapshot: Callable[[SparkSession], DataFrame]
    snap_key: str
    delta: Callable[[SparkSession], DataFrame] | None = None
    delta_key: str | None = None
    mark: str | None = None
    full_version: object = 0
    full_order: tuple = ()
    latest_only: bool = False
    ordered: bool = True
    mode: str = "auto"
    delta_sql: str | None = None
    add_envelope: bool = True
    salt: int | None = None
    problem: str | None = None


def sql_spec(name: str, *, full_sql: str | None = None, delta_sql: str | None = None,
             mark_table: str | None = None, mark: str | None = None, snap_key: str | None = None,
             **kw) -> MirrorSpec:
    """A mirror defined by SQL over registered views, like a folder with
    `full.sql` / `delta.sql`. The delta statement computes the change rows
    itself and takes `:low` and `:high` (the saved and the fixed upper mark);
    `mark_table.mark` is the rising request column."""
    if full_sql is None and delta_sql is None:
        raise ValueError("give full_sql, delta_sql or both")
    snapshot = (lambda s: s.sql(full_sql)) if full_sql else None
    delta = (lambda s: s.table(mark_table)) if mark_table else None
    mode = kw.pop("mode", "auto" if full_sql else "delta")
    return MirrorSpec(name=name, snapshot=snapshot, snap_key=snap_key or "", delta=delta, mark=mark,
                      delta_sql=delta_sql, mode=mode, add_envelope=False, **kw)


def specs_in_folder(spark: SparkSession, folder: str) -> list[MirrorSpec]:
    """One SQL-defined spec per sub-folder holding `full.sql` and/or
    `delta.sql`, plus `mirror.json` naming `watermark_table`,
    `watermark_column` and optionally the snapshot key."""
    from ..sources.sql import bind_placeholders
    specs = []
    for sub in paths.list_dirs(spark, folder):
        base = f"{folder.rstrip('/')}/{sub}"
        texts = {n: paths.read_text(spark, f"{base}/{n}") for n in ("full.sql", "delta.sql", "mirror.json")}
        conf = json.loads(texts["mirror.json"]) if texts["mirror.json"] else {}
        common = dict(mark_table=conf.get("watermark_table"), mark=conf.get("watermark_column"),
                      snap_key=conf.get("snapshot_key"))
        if texts["full.sql"] or texts["delta.sql"]:
            specs.append(sql_spec(sub, full_sql=texts["full.sql"] and bind_placeholders(texts["full.sql"].strip()),
                                  delta_sql=texts["delta.sql"] and bind_placeholders(texts["delta.sql"].strip()),
                                  **common))
            continue
        # No full or delta statement: query.sql, else the first *.sql, runs
        # in full on every call.
        names = [n for n in paths.list_files(spark, base) if n.lower().endswith(".sql")]
        pick = "query.sql" if "query.sql" in names else (names[0] if names else None)
        if pick is not None:
            text = paths.read_text(spark, f"{base}/{pick}") or ""
            specs.append(sql_spec(sub, full_sql=bind_placeholders(text.strip()), mode="full", **common))
        else:
            specs.append(MirrorSpec(name=sub, snapshot=None, snap_key="", problem=f"{base} holds no SQL statement"))
    return specs


@dataclass
class MirrorResult:
    name: str
    mode: str = ""
    seq: int = 0
    rows: int = 0
    watermark: object = None
    error: str | None = None
    elapsed: float = 0.0
    extra: dict = field(default_factory=dict)


def _decode(text, type_name):
    if text is None:
        return None
    if type_name in ("bigint", "int", "smallint", "tinyint"):
        return int(text)
    if type_name in ("double", "float"):
        return float(text)
    if type_name and type_name.startswith("decimal"):
        return Decimal(text)
    if type_name in ("timestamp", "timestamp_ntz"):
        return dt.datetime.fromisoformat(text)
    if type_name == "date":
        return dt.date.fromisoformat(text)
    if type_name == "string":
        return text
    if type_name is not None:
        raise ValueError(f"cannot read a mark of type {type_name}")
    try:
        return int(text)
    except ValueError:
        return text


def _lowest(type_name: str | None):
    """A value below all marks of a type (for text and dates: below all that
    occur), so that a statement's `mark > :low` keeps every request."""
    if type_name in ("timestamp", "timestamp_ntz"):
        return "0001-01-01 00:00:00"
    if type_name == "date":
        return "0001-01-01"
    if type_name == "string":
        return ""
    if type_name in ("double", "float"):
        return float("-inf")
    if type_name and type_name.startswith("decimal"):
        precision, scale = (int(x) for x in type_name[8:-1].split(","))
        return -Decimal(10) ** (precision - scale)
    bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(type_name, 64)
    return -(1 << (bits - 1))


def _encode(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def published_sequences(spark: SparkSession, root: str, name: str) -> list[int]:
    """Sequence folders of a feed, committed or not."""
    return sorted(int(d[4:]) for d in paths.list_dirs(spark, f"{root.rstrip('/')}/{name}") if d.startswith("seq="))


def _state_of(log: feed_log.Log) -> dict:
    d = dict(log.doc)
    d["last_watermark"] = _decode(d.get("last_watermark"), d.get("watermark_type"))
    d["last_sequence"] = int(d["last_sequence"] or 0)
    return d


def load_log(spark: SparkSession, root: str, name: str) -> feed_log.Log | None:
    """The feed's log, None before its first run. A feed with sequence folders
    but no readable state is an error: starting over would overwrite it."""
    log = feed_log.read_log(spark, root, name)
    if log is None and (seqs := published_sequences(spark, root, name)):
        raise RuntimeError(f"{name} has sequences up to {seqs[-1]} but no readable state in {state_dir(root, name)}")
    return log


def load_state(spark: SparkSession, root: str, name: str) -> dict:
    """The newest readable state; before the first run it starts from zero.

    Every commit adds a small JSON document and never touches the ones before
    it, so a crash leaves the last state readable."""
    log = load_log(spark, root, name)
    return _state_of(log) if log is not None else {"last_sequence": 0, "last_watermark": None}


def save_state(spark: SparkSession, root: str, name: str, *, seq: int, watermark, watermark_type: str | None,
               watermark_column: str | None, mode: str, after: feed_log.Log | None = None, run: str | None = None,
               rows: int = 0, schema=None, **more) -> feed_log.Log:
    """Add the state that follows `after` (default: the newest one), and
    with `run` publish that run's folder as sequence `seq` in the same step.
    A `feed_log.CommitConflict` means that another writer did so first."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    values = (name, int(seq), _encode(watermark), watermark_type, watermark_column, mode, now)
    after = after if after is not None else feed_log.read_log(spark, root, name)
    log = feed_log.commit(spark, root, name, after, {**dict(zip(STATE_FIELDS, values)), **more}, seq=int(seq), run=run,
                          rows=rows, schema=schema)
    if run is not None:
        feed_log.drop_other_runs(spark, root, name, int(seq), run)
    return log


def choose_mode(spec: MirrorSpec, seq: int) -> str:
    if spec.mode != "auto":
        return spec.mode
    if seq == 0:
        return "full"
    return "delta" if spec.delta_sql is not None or (spec.delta is not None and spec.delta_key) else "full"


def mirror(spark: SparkSession, spec: MirrorSpec, root: str, *, high=None) -> MirrorResult:
    """One mirror step for one table (see module doc). `high` fixes the
    upper mark (default: the delta table's current maximum)."""
    res = MirrorResult(name=spec.name)
    start = time.perf_counter()
    try:
        if spec.problem:
            raise ValueError(spec.problem)
        log = load_log(spark, root, spec.name)
        state = _state_of(log) if log is not None else {"last_sequence": 0, "last_watermark": None}
        if "writer" in state:
            raise ValueError(f"{spec.name} is written by the stream with checkpoint {state['writer']}")
        seq = state["last_sequence"]
        last = state["last_watermark"]
        mode = res.mode = choose_mode(spec, seq)
        delta = spec.delta(spark) if spec.delta is not None else None
        mark_type = delta.schema[spec.mark].dataType.simpleString() if delta is not None else None
        bounds = None
        if delta is not None and spec.delta_key:
            # One small job over the delta side: the upper mark (only marks
            # above the saved one can raise it, and the pushed filter lets an
            # append-only table skip old row groups) and the key range of the
            # requests in (last, high], used to prune the snapshot scan.
            top, kmin, kmax = delta_key_bounds(delta, delta_key=spec.delta_key, mark=spec.mark, low=last, high=high)
            high = top if top is not None else last
            bounds = (kmin, kmax)
        elif delta is not None and high is None:
            high = delta.where(mark_range(delta[spec.mark], last, None, delta.schema[spec.mark].dataType)) \
                .agg(F.max(spec.mark)).first()[0]
            if high is None:
                high = last
        snapshot = spec.snapshot(spark) if spec.snapshot is not None else None
        if mode == "full" and snapshot is None:
            mode = res.mode = "delta"
        if log is None:
            # From here on a feed without a state is a damaged one.
            log = save_state(spark, root, spec.name, seq=0, watermark=None, watermark_type=mark_type,
                             watermark_column=spec.mark, mode=mode)
        if mode == "full":
            # A SQL full refresh carries its own envelope and ORDER BY.
            rows = envelope(snapshot, version=spec.full_version) if spec.add_envelope else snapshot
            order = list(spec.full_order) if spec.ordered and spec.full_order else None
            # Each file is sorted by key (row groups then skip by key range);
            # a global order of a whole snapshot would shuffle all of it.
            n, run = write_run(rows, root, spec.name, seq + 1, sort_within=order)
            new_mark = high if delta is not None else last
        elif mode == "delta" and spec.delta_sql is not None:
            # The statement computes the change rows; its ORDER BY is kept.
            # Without a `:high` bound it may include requests that arrived
            # after `high` was fixed; as the state records `high`, those are
            # read again next time (at least once, never lost).
            # Without a saved mark `:low` is the lowest value of the mark's type.
            args = {"low": bindable(last if last is not None else _lowest(mark_type), mark_type),
                    "high": bindable(high, mark_type)}
            rows = spark.sql(spec.delta_sql, args={k: v for k, v in args.items() if f":{k}" in spec.delta_sql})
            n, run = write_run(rows, root, spec.name, seq + 1)
            new_mark = (next_watermark(delta, spec.mark, last, high) if delta is not None else last)
        elif mode == "delta":
            if delta is None:
                raise ValueError("delta mode needs a delta table")
            observed = {"high_seen": F.max(MARK)}
            order = None
            stage = scratch_dir(spark, "changes")
            try:
                rows = change_rows(delta, snapshot, delta_key=spec.delta_key, snap_key=spec.snap_key, mark=spec.mark,
                                   low=last, high=high, latest_only=spec.latest_only, keep_mark=True,
                                   snap_bounds=bounds, salt=spec.salt, stage=stage)
                if spec.ordered:
                    rows, order = change_order(rows, spec.snap_key)
                rows_out = rows.drop(MARK, TIE)
                n, run = write_run(rows, root, spec.name, seq + 1, sort_by=order, metrics=observed, drop=(MARK, TIE), stored=True)
                rows = rows_out
            finally:
                paths.delete(spark, stage)
            # Every delta row in range gives at least one change row, so the
            # largest mark written is the new high-water mark.
            new_mark = observed["high_seen"] if observed["high_seen"] is not None else last
        else:
            raise ValueError(f"unknown mode {mode!r}")
        if n > 0:
            seq += 1
        try:
            save_state(spark, root, spec.name, seq=seq, watermark=new_mark, watermark_type=mark_type,
                       watermark_column=spec.mark, mode=mode, after=log, run=run, rows=n, schema=rows.schema)
        except feed_log.CommitConflict:
            if run is not None:
                discard_run(spark, root, spec.name, seq, run)
            raise
        res.seq, res.rows, res.watermark = seq, n, new_mark
    except Exception as exc:  # one table's failure is reported, not raised
        res.error = f"{type(exc).__name__}: {exc}"
    finally:
        res.elapsed = time.perf_counter() - start
    return res


def mirror_all(spark: SparkSession, specs: list[MirrorSpec], root: str, *, parallel: int = 1, **kw) -> list[MirrorResult]:
    """Every table independently, up to `parallel` at a time; each run
    (failures too) is appended, in name order, to the run log under
    `<root>/_runs`."""
    from .export import ExportResult, append_run_log
    results = run_units(spark, [partial(mirror, spark, s, root, **kw) for s in sorted(specs, key=lambda s: s.name)], parallel)
    append_run_log(spark, f"{root.rstrip('/')}/_runs",
                   [ExportResult(name=r.name, rows=r.rows, elapsed=r.elapsed, error=r.error) for r in results])
    return results
