"""Sharding by jump consistent hashing.

Law ``key``: a row's shard depends on its key and the shard count alone. There
is no ring table, and when a shard is appended a row either keeps its shard or
moves into the new one (about 1 row in n + 1 moves).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workers import send_code

OVERHEAD = 16
CHUNKS = 128
_COPIES = 1 << 16


def jump(keys: np.ndarray, n: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys to shards 0..n-1."""
    key = keys.astype(np.uint64).copy()
    b = np.full(len(key), -1, dtype=np.int64)
    j = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            b[live] = j[live]
            key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
            step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
            j[live] = ((b[live] + 1) * step).astype(np.int64)
            live = live[j[live] < n]
    return b


def _jump_column(n: int):
    @F.pandas_udf("int")
    def f(key: pd.Series) -> pd.Series:
        return pd.Series(jump(key.to_numpy(np.int64).view(np.uint64), n).astype(np.int32))
    return f


def assign_shards(docs: DataFrame, n_shards: int, *, id_col: str = "doc_id", text_col: str = "text",
                  chunks: int = CHUNKS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.

    Slots are numbered from 0 without gaps in each shard, by parallel
    numbering: the rows of a shard fall into ``chunks`` chunks by a hash of id
    and text, a chunk numbers its own rows, and starts at the rows of the
    chunks before it. So an id that many rows share is numbered by many tasks;
    rows equal in id and text are counted before the shuffle and numbered as
    one. The table of starts has at most ``n_shards * chunks`` rows, which is
    why it is broadcast.

    A null text has no bytes (size 16, crc of the empty string). Null ids
    share one key, hence one shard. Repeated rows each get a slot. Very long
    texts and other columns of any name are fine; an empty table gives no rows.
    """
    send_code(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    d = d.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", F.xxhash64("text")).alias("spread"))
    d = d.groupBy("doc_id", "size", "text_crc32", "spread").agg(F.count("*").alias("n"))
    # xxhash64 spreads consecutive ids; jump needs well mixed keys.
    d = d.withColumn("key", F.xxhash64("doc_id"))
    d = d.select("*", _jump_column(n_shards)("key").alias("shard"), _jump_column(n_shards + 1)("key").alias("grown_shard"),
                 F.pmod(F.xxhash64("spread", F.lit("slot")), F.lit(chunks)).cast("int").alias("chunk"))
    counts = d.groupBy("shard", "chunk").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size", "spread").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("n").over(order), F.lit(0))
    # Equal rows come back one by one, a bounded number at a time.
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES).cast("long"))
    copies = F.sequence(F.col("step") * _COPIES, F.least((F.col("step") + 1) * _COPIES, F.col("n")) - 1)
    return (d.join(F.broadcast(starts), ["shard", "chunk"]).withColumn("first", first).withColumn("step", F.explode(steps))
            .withColumn("copy", F.explode(copies))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("copy")).alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int, *, id_col: str = "doc_id", split: int = 16) -> None:
    """Writes the rows into one folder per shard (``shard=0`` ...), each shard
    by up to ``split`` tasks, so neither a shard nor a repeated id has to pass
    through one task."""
    send_code(docs.sparkSession)
    shard = "__shard" if "shard" in docs.columns else "shard"
    key = F.xxhash64(F.col(id_col))
    (docs.withColumn(shard, _jump_column(n_shards)(key))
     .repartition(n_shards * split, F.col(shard), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(split)))
     .write.mode("overwrite").partitionBy(shard).parquet(path))
