"""Quality classifier on learned subword embeddings.

Words and character n-grams are hashed to buckets; every bucket has a learned
vector. N-grams are taken from the text and from its shape (letters, digits
and marks without their identity); a word that repeats the one before counts
as a word of its own kind. A document is the average of the vectors of its
words and n-grams, and a softmax layer on it gives the probability of good
quality. Vectors and layer are trained together by stochastic gradient descent
in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ngrams
from .sampling import id_remainder, sample_per_class
from .workers import send_code

PER_CLASS = 800
BITS = 12
DIM = 10
EPOCHS = 12
#: Averages of many vectors are small; inputs are scaled up to learn at a
#: useful pace.
SCALE = 30.0
_ORDERS = (2, 3, 4)
_SHAPE_ORDERS = (3, 4, 6)
_REPEAT = 0


def describe(text: str | None) -> np.ndarray:
    """Weights of all buckets in the average: words, n-grams and shape n-grams
    make up a third each (an empty text: all zero)."""
    size = 1 << BITS
    total = np.zeros((3, size))
    for part in ngrams.chunks(text) if text else ():
        a = np.frombuffer(b" " + part.encode() + b" ", dtype=np.uint8)
        words = ngrams.words(a, BITS)
        total[0] += np.bincount(words, minlength=size)
        for n in _ORDERS:
            total[1] += np.bincount(ngrams.ngrams(a, n, BITS), minlength=size)
        shape = ngrams.shape(f" {part} ")
        for n in _SHAPE_ORDERS:
            total[2] += np.bincount(ngrams.ngrams(shape, n, BITS), minlength=size)
        total[2, _REPEAT] += len(_SHAPE_ORDERS) * np.count_nonzero(words[1:] == words[:-1])
    sums = np.maximum(total.sum(axis=1, keepdims=True), 1.0)
    return (total / sums / 3).astype(np.float32).ravel()


@dataclass
class QualityModel:
    embeddings: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.embeddings) @ self.layer + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return (z / z.sum(axis=1, keepdims=True))[:, 1].astype(np.float64)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, dim: int = DIM, epochs: int = EPOCHS, batch: int = 32,
          rate: float = 0.5, seed: int = 0) -> QualityModel:
    """Stochastic gradient descent on the weighted cross-entropy of classes
    0 and 1, with bounded steps; the rate falls linearly to zero."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (x.shape[1], dim)).astype(np.float32)
    u = rng.normal(0, 0.1, (dim, 2)).astype(np.float32)
    b = np.zeros(2, dtype=np.float32)
    target = np.eye(2, dtype=np.float32)[y]
    steps, at = epochs * -(-len(x) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), batch):
            i = order[k:k + batch]
            lr = np.float32(rate * (1 - at / steps))
            at += 1
            xi = x[i] * np.float32(SCALE)
            v = xi @ e
            z = v @ u + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = (z / z.sum(axis=1, keepdims=True) - target[i]) * weight[i, None] / len(i)
            ge, gu = xi.T @ (d @ u.T), v.T @ d
            lr = lr / max(np.float32(1.0), np.sqrt((ge * ge).sum() + (gu * gu).sum()))
            e -= lr * ge
            u -= lr * gu
            b -= lr * d.sum(axis=0)
    return QualityModel((e * np.float32(SCALE)).astype(np.float32), u, b)


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", per_class: int = PER_CLASS) -> QualityModel | None:
    """Learns from labelled documents whose id is not held out (crc32 of the
    id as text, modulo 3, is not 1): about ``per_class`` of each class, weighed
    by the classes' true shares. Of several texts of one id the smallest is the
    example. None unless both classes have examples."""
    send_code(docs.sparkSession)
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (id_remainder("doc_id", 3) != 1))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    picked = sample_per_class(marks, "label", ["doc_id"], counts, per_class, "quality")
    # The sample is bounded by per_class, so it may be sent to every task.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "doc_id")
    # One text stands for an id, however often the id is repeated.
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [describe(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.binary())], names=["doc_id", "label", "v"])

    rows = texts.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(
        run, "doc_id long, label int, v binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.v)))
    if len({r.label for r in rows}) < 2:
        return None
    x = np.stack([np.frombuffer(bytes(r.v), dtype=np.float32) for r in rows])
    y = np.array([r.label for r in rows])
    total, here = sum(counts.values()), np.bincount(y, minlength=2)
    share = np.array([counts[c] / total / (here[c] / len(y)) for c in (0, 1)], dtype=np.float32)
    return train(x, y, share[y])


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts have no features and get the score of the bias alone.
    Without labels of both classes every score is 0.5. A null id is never held
    out nor learned from; of several labels of a document the largest counts.
    Every row is scored by its own text, which is read whole; rows that repeat
    are all returned, an empty table gives no rows, and other columns, whatever
    their names, are not looked at.
    """
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_class=per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = np.full(b.num_rows, 0.5)
            if m is not None:
                for at in range(0, b.num_rows, 256):
                    x = np.stack([describe(t.as_py()) for t in b.column(0).slice(at, 256)])
                    out[at:at + 256] = m.scores(x)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out)], names=["doc_id", "held_out", "score"])

    d = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(id_remainder(id_col, 3) == 1, F.lit(False)).alias("held_out"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
