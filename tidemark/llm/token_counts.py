"""Token counts without token ids.

Texts are encoded in Arrow functions that return lengths only. They are taken in
batches of equal bytes, short texts together and long ones split where the
tokenizer always splits, and the distinct unknown pieces of a batch go to the
tokenizers library in one call.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import PieceEncoder, load_tokenizer, read_spec, worker_encoder
from .workers import send_code

BATCH_BYTES = 1 << 20


def count_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, *, limit: int = 512, rule: str = "keep",
                 id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Counts equal those of encoding the whole text at once: no special tokens
    are added, no truncation, and special strings inside a text are handled
    as the library does by default. A null or empty text has 0 bytes and 0
    tokens. One row per input row, whatever repeats; an empty table gives no
    rows. Very long texts take several batches. Other columns may have any
    name. Ids must be integers (or cast to them).
    """
    send_code(spark)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(spec.value)
        enc = worker_encoder(("lengths", spec.value, rule, batch_bytes), lambda: PieceEncoder(
            lambda ps: [len(e.ids) for e in tok.encode_batch_fast(ps, add_special_tokens=False)], rule, batch_bytes))
        for b in batches:
            n = [sum(v) for v in enc.many([t or "" for t in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return (d.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
