"""Polling a table from the saved mark, as a stream.

A poll looks up the table's largest mark and, if it has risen, announces the
requests it found as a range `(low, high]`: one small numbered document, created
only if no other poll made that number first. The ranges are a file stream;
each becomes one micro-batch that reads its requests from the table itself.
So a batch that is replayed after a crash, between its offset and its commit,
covers the same requests as before, whatever arrived meanwhile; those wait
for the next range.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import mark_range
from ..plans.mirror import MirrorSpec, _decode, _encode, load_state
from ..sources import paths
from .mirror_stream import stream_mirror

RANGE = "low string, high string, type string"


def ranges_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_ranges/{name}"


def announce(spark: SparkSession, spec: MirrorSpec, root: str, *, high=None) -> tuple | None:
    """Look up what is new in the polled table, up to `high` if given, and
    announce it; returns `(low, high)`, or None if nothing is new. The first
    range starts at the feed's saved mark, later ones where the last ended."""
    base = ranges_dir(root, spec.name)
    names = [n for n in paths.list_files(spark, base) if n.endswith(".json")]
    delta = spec.delta(spark)
    dtype = delta.schema[spec.mark].dataType
    if names:
        last = json.loads(paths.read_text(spark, f"{base}/{names[-1]}"))
        low, number = _decode(last["high"], last["type"]), int(names[-1].split(".")[0]) + 1
    else:
        low, number = load_state(spark, root, spec.name)["last_watermark"], 0
    top = delta.where(mark_range(delta[spec.mark], low, high, dtype)).agg(F.max(spec.mark)).first()[0]
    if top is None:
        return None
    text = json.dumps({"low": _encode(low), "high": _encode(top), "type": dtype.simpleString()})
    if not paths.create_new(spark, f"{base}/{number:012d}.json", text):
        raise RuntimeError(f"{spec.name}: another poll announced range {number} first")
    return low, top


def poll_mirror(spark: SparkSession, spec: MirrorSpec, root: str, *, high=None, polls: int = 1, interval: float = 0.0,
                checkpoint: str | None = None):
    """Mirror a polled table: `polls` times announce what is new and write the
    announced ranges as change sets, one sequence each, `interval` seconds
    apart. Ranges that an earlier call announced and did not finish come first.
    Returns the last StreamingQuery (None if nothing was ever announced)."""
    if spec.delta is None or spec.snapshot is None or not (spec.delta_key and spec.mark):
        raise ValueError("a polled mirror needs a snapshot, and a delta table with its key and mark")
    root = root.rstrip("/")
    mark_type = spec.delta(spark).schema[spec.mark].dataType.simpleString()

    def requests(batch: DataFrame) -> DataFrame:
        (low, high, kind) = batch.first()  # one file, one range
        delta = spec.delta(spark)
        return delta.where(mark_range(delta[spec.mark], _decode(low, kind), _decode(high, kind), delta.schema[spec.mark].dataType))

    query = None
    for k in range(polls):
        if k:
            time.sleep(interval)
        announce(spark, spec, root, high=high)
        if not paths.list_files(spark, ranges_dir(root, spec.name)):
            continue
        ranges = (spark.readStream.schema(RANGE).option("maxFilesPerTrigger", "1").option("pathGlobFilter", "*.json")
                  .json(ranges_dir(root, spec.name)))
        query = stream_mirror(spark, ranges, spec.snapshot, name=spec.name, root=root, delta_key=spec.delta_key,
                              snap_key=spec.snap_key, mark=spec.mark, ordered=spec.ordered, checkpoint=checkpoint,
                              requests=requests, mark_type=mark_type)
    return query
