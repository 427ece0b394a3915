"""The mirror as a Structured Streaming query.

New delta files are picked up by the file source; each micro-batch becomes
one change set, numbered on from where the feed stood when the stream began,
written and published as the batch mirror does. A restarted query resumes
after the last committed batch. A replayed batch either was not published,
and is written again, or finds all its marks read and adds nothing, so the
feed is exactly-once.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import mark_range
from ..operators.joins import MARK, TIE, change_order, change_rows, delta_key_bounds
from ..plans.mirror import load_log, load_state, save_state
from ..session import scratch_dir
from ..sources import feed_log, paths
from ..sources.sinks import discard_run, write_run


def delta_stream(spark: SparkSession, source_dir: str, *, schema=None, max_files_per_trigger: int | None = None,
                 path_glob: str | None = None) -> DataFrame:
    """Streaming read of delta request files (Parquet) from a folder."""
    schema = schema or spark.read.parquet(source_dir).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.parquet(source_dir)


def stream_mirror(spark: SparkSession, deltas: DataFrame, snapshot: Callable[[SparkSession], DataFrame], *, name: str,
                  root: str, delta_key: str, snap_key: str, mark: str, ordered: bool = True,
                  checkpoint: str | None = None, available_now: bool = True, processing_time: str | None = None,
                  requests: Callable[[DataFrame], DataFrame] | None = None, mark_type: str | None = None):
    """Start the streaming mirror; returns the StreamingQuery (already
    finished when `available_now`).

    A new stream goes on after the feed's saved sequence and mark; the state
    then names its checkpoint, and another writer of the feed is refused.
    Requests at or below the saved mark are late and not read, so the mark
    never falls. `snapshot` is called for every batch, which sees the data of
    that moment. `requests` turns a micro-batch into the delta requests it
    stands for, whose mark has `mark_type` (default: the batch itself).
    """
    root = root.rstrip("/")
    mark_type = mark_type or deltas.schema[mark].dataType.simpleString()
    checkpoint = checkpoint or f"{root}/_checkpoints/{name}"
    state = load_state(spark, root, name)
    if state.get("writer") not in (None, checkpoint):
        raise ValueError(f"{name} is written by the stream with checkpoint {state['writer']}")
    if "writer" not in state:
        state = {**state, "writer": checkpoint, "base": state["last_sequence"]}
        save_state(spark, root, name, seq=state["last_sequence"], watermark=state["last_watermark"], watermark_type=mark_type,
                   watermark_column=mark, mode="stream", writer=checkpoint, base=state["base"])
    base = int(state["base"])

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        log, now = load_log(spark, root, name), load_state(spark, root, name)
        if now.get("writer") != checkpoint:
            raise RuntimeError(f"{name} got another writer: {now.get('writer')}")
        low, seq = now["last_watermark"], base + batch_id + 1
        batch = requests(batch) if requests is not None else batch
        batch = batch.where(mark_range(batch[mark], low, None, batch.schema[mark].dataType)).persist()
        stage = scratch_dir(spark, "changes")
        try:
            _, kmin, kmax = delta_key_bounds(batch, delta_key=delta_key, mark=mark, low=low)
            rows = change_rows(batch, snapshot(spark), delta_key=delta_key, snap_key=snap_key, mark=mark, low=low,
                               keep_mark=True, snap_bounds=(kmin, kmax), stage=stage)
            order = None
            if ordered:
                rows, order = change_order(rows, snap_key)
            observed = {"high_seen": F.max(MARK)}
            n, run = write_run(rows, root, name, seq, sort_by=order, metrics=observed, drop=(MARK, TIE), stored=True)
            if n > 0:
                try:
                    save_state(spark, root, name, seq=seq, watermark=observed["high_seen"], watermark_type=mark_type,
                               watermark_column=mark, mode="stream", after=log, run=run, rows=n,
                               schema=rows.drop(MARK, TIE).schema, writer=checkpoint, base=base)
                except feed_log.CommitConflict:
                    discard_run(spark, root, name, seq, run)
                    raise
        finally:
            batch.unpersist()
            paths.delete(spark, stage)

    writer = deltas.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
