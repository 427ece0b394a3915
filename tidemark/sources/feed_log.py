"""The commit log of a change feed: its state (T2) and its list of sequences.

A run writes its rows into a folder of its own (`seq=N/run=<id>`), which no
reader looks into yet. It is published by one step: creating the next numbered
state document, which names the folder, if and only if no other writer created
that number first. So of two writers that started from the same state one is
refused, readers see a sequence whole or not at all, and nothing is renamed.

A state document lists the newest sequences. Every `SEGMENT` of them are sealed
into a file of their own, so a document stays small however long the feed is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..fixed import SEQUENCE_DIGITS
from . import paths

KEEP_STATES = 5
SEGMENT = 1000


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def state_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_state/{name}"


def sequence_dir(root: str, name: str, seq: int, digits: int = SEQUENCE_DIGITS) -> str:
    return f"{root.rstrip('/')}/{name}/seq={seq:0{digits}d}"


def run_dir(root: str, name: str, seq: int, run: str) -> str:
    return f"{sequence_dir(root, name, seq)}/run={run}"


@dataclass
class Log:
    """A feed's newest state document and what it says about sequences.

    `entries` are the sequences not sealed yet: [sequence, run, rows, place of
    its schema in `schemas`]; `sealed` has the last sequence of each sealed
    file."""
    number: int = -1
    doc: dict = field(default_factory=dict)

    @property
    def entries(self) -> list:
        return self.doc.get("entries", [])

    @property
    def sealed(self) -> list:
        return self.doc.get("sealed", [])

    @property
    def schemas(self) -> list:
        return self.doc.get("schemas", [])


def _documents(spark: SparkSession, root: str, name: str) -> list[str]:
    return [n for n in paths.list_files(spark, state_dir(root, name)) if n.endswith(".json")]


def _segment(root: str, name: str, k: int) -> str:
    return f"{state_dir(root, name)}/sealed/{k:09d}.json"


def read_log(spark: SparkSession, root: str, name: str) -> Log | None:
    """The newest readable state document; None if there is none. `number` is
    that of the newest document, readable or not, so the next one is free."""
    names = _documents(spark, root, name)
    number = int(names[-1].split(".")[0]) if names else -1
    for n in reversed(names):
        try:
            doc = json.loads(paths.read_text(spark, f"{state_dir(root, name)}/{n}") or "")
        except ValueError:
            continue
        if isinstance(doc, dict) and "last_sequence" in doc:
            return Log(number, doc)
    return None


def commit(spark: SparkSession, root: str, name: str, after: Log | None, state: dict, *, seq: int | None = None,
           run: str | None = None, rows: int = 0, schema: T.StructType | None = None) -> Log:
    """Add the state that follows `after`, and with `run` the sequence `seq` of
    that run's folder. Raises `CommitConflict`, and changes nothing, if another
    writer followed `after` first."""
    entries = [list(e) for e in (after.entries if after else [])]
    sealed, schemas = (list(after.sealed), list(after.schemas)) if after else ([], [])
    while len(entries) >= SEGMENT:
        # Committed entries only, so every writer would seal the same ones.
        paths.create_new(spark, _segment(root, name, len(sealed)), json.dumps(entries[:SEGMENT]))
        sealed.append(entries[SEGMENT - 1][0])
        entries = entries[SEGMENT:]
    if run is not None:
        text = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).json()
        if text not in schemas:
            schemas.append(text)
        entries.append([seq, run, rows, schemas.index(text)])
    number = (after.number if after else -1) + 1
    doc = {**state, "sealed": sealed, "schemas": schemas, "entries": entries}
    if not paths.create_new(spark, f"{state_dir(root, name)}/{number:012d}.json", json.dumps(doc, indent=1)):
        raise CommitConflict(f"{name}: another writer committed state {number} first")
    for old in _documents(spark, root, name)[:-KEEP_STATES]:
        paths.delete(spark, f"{state_dir(root, name)}/{old}")
    return Log(number, doc)


def sequences(spark: SparkSession, root: str, name: str, log: Log, low: int | None = None, high: int | None = None) -> list[list]:
    """Entries of the sequences in `(low, high]`, oldest first. Sealed files
    outside the range are not read."""
    found = []
    for k, last in enumerate(log.sealed):
        before = log.sealed[k - 1] if k else 0
        if (low is None or last > low) and (high is None or before < high):
            found += json.loads(paths.read_text(spark, _segment(root, name, k)) or "[]")
    found += log.entries
    return [e for e in found if (low is None or e[0] > low) and (high is None or e[0] <= high)]


def drop_other_runs(spark: SparkSession, root: str, name: str, seq: int, run: str) -> None:
    """Clears what refused or killed writers left of a committed sequence. Who
    still writes there started from an older state and can no longer commit."""
    base = sequence_dir(root, name, seq)
    for d in paths.list_dirs(spark, base):
        if d != f"run={run}":
            paths.delete(spark, f"{base}/{d}")


def merged_schema(schemas: list[str]) -> T.StructType:
    """All columns of the schemas, by name, in order of appearance. Integers
    of different width become the wider; other differences are errors, as
    when Spark merges footers."""
    wide = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    fields: dict[str, T.DataType] = {}
    for text in schemas:
        for f in T.StructType.fromJson(json.loads(text)).fields:
            have = fields.setdefault(f.name, f.dataType)
            if have != f.dataType:
                if have not in wide or f.dataType not in wide:
                    raise ValueError(f"column {f.name!r} is {have.simpleString()} in one sequence and "
                                     f"{f.dataType.simpleString()} in another")
                fields[f.name] = max(have, f.dataType, key=wide.index)
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])
