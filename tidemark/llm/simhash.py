"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. If two fingerprints differ in
at most two bits, one segment has no error and the segment after it at most
two, so they share (segment number, exact segment, a Golay key of the next
segment). Distinct fingerprints meet on these keys and are verified by their
bit distance.

A key shared by more fingerprints than ``cap`` is not compared in pairs: each
of its fingerprints is listed under itself and its 64 one-bit neighbours, and
everything listed under one word (at most 65 fingerprints, all within two bits
of each other) is linked to the smallest of them. Two fingerprints within two
bits always share such a word, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from . import golay
from .components import connected_components
from .workers import send_code

SHINGLE = 3
MAX_BITS = 2
SEED = 42
CAP = 64
WIDTHS = (22, 21, 21)
_STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned SimHash of a whole text; 0 without words."""
    import xxhash
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(w), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n, ones = len(w) - shingle + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _STEP):
        part = w[at:at + _STEP + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle)))
        h = np.array([digest(join(g), seed) for g in grams], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 version: bool = False) -> DataFrame:
    """``doc_id, fp`` (fingerprint as a signed long) of every row, and with
    ``version`` the hash of its text between them."""
    names = ["doc_id", "version", "fp"] if version else ["doc_id", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(v)], names=names)

    hashed = [F.xxhash64(F.col(text_col)).alias("version")] if version else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *hashed).mapInArrow(
        run, ", ".join(f"{n} long" for n in names))


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u, out, at = fp.view(np.uint64), [], 0
    for w in WIDTHS:
        out.append(((u >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64))
        at += w
    return out


def _golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy()
        seg = _segments(fp)
        for i in range(3):
            k = golay.keys(seg[(i + 1) % 3])
            row, col = np.nonzero(k != golay.NO_KEY)
            key = (i << 40) | (seg[i][row] << 12) | k[row, col]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for b in batches:
        fp = b.column(0).to_numpy()
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            near = (part.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel()), pa.array(np.repeat(part, 65))],
                                             names=["near", "fp"])


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, cap: int = CAP) -> DataFrame:
    """``a, b`` links whose components are those of all pairs of distinct
    fingerprints within ``max_bits`` (at most 2)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the code finds up to {MAX_BITS} differing bits, not {max_bits}")
    keys = fps.select("fp").mapInArrow(_golay_keys, "key long, fp long")
    shared = keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    small = shared.where(F.col("n") <= cap)
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    pairs = (left.join(right, "key").where("a < b")
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))
    if max_bits < MAX_BITS:
        # The neighbour words find distance 2; below that compare them too.
        cap_pairs = shared.where(F.col("n") > cap)
        near = cap_pairs.select("fp").distinct().mapInArrow(_neighbours, "near long, fp long")
        known = fps.select(F.col("fp").alias("near"))
        crowd = near.join(known, "near").select(F.col("near").alias("a"), F.col("fp").alias("b")).where("a <> b")
        if max_bits == 0:
            crowd = crowd.where(F.lit(False))
        return pairs.union(crowd)
    crowd = shared.where(F.col("n") > cap).select("fp").distinct().mapInArrow(_neighbours, "near long, fp long")
    stars = crowd.groupBy("near").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("near", "a")
    return pairs.union(crowd.join(stars, "near").where("fp <> a").select("a", F.col("fp").alias("b")))


def _members(spark: SparkSession, docs: DataFrame, shingle: int, max_bits: int, cap: int, id_col: str, text_col: str,
             version: bool) -> DataFrame:
    """``fingerprints`` of every row with ``root``, which is one fingerprint of
    its component and names no other, and ``component_id``."""
    send_code(spark)
    base = scratch_dir(spark, "simhash")
    fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col, version=version).write.parquet(f"{base}/documents")
    rows = spark.read.schema(f"doc_id long, {'version long, ' if version else ''}fp long").parquet(f"{base}/documents")
    rows.groupBy("fp").agg(F.min("doc_id").alias("rep")).write.parquet(f"{base}/fingerprints")
    fps = spark.read.schema("fp long, rep long").parquet(f"{base}/fingerprints")
    roots = connected_components(spark, links(fps, max_bits=max_bits, cap=cap), "a", "b")
    classes = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = classes.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def near_duplicates(spark: SparkSession, docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    ``component_id`` is the smallest id of a document reachable over links of
    at most ``max_bits`` differing bits. Null and empty texts and texts
    without words have fingerprint zero and link like any other. A null id
    never names a component unless all its members have none.
    """
    found = _members(spark, docs, shingle, max_bits, cap, id_col, text_col, version=False)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                     cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns as they are: that of the
    smallest id, and of its rows that of the smallest text hash. Rows without
    an id come after all ids. An id with texts in several components can stay
    once in each; rows equal in id and text are one document, of which the
    smallest by all its columns stays (columns that have no order, such as
    maps, do not count). Null, empty and very long texts are fine, columns may
    have any name, and an empty table stays empty."""
    found = _members(spark, docs, shingle, max_bits, cap, id_col, text_col, version=True)
    heads = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
             .agg(F.min("doc_id").alias("__id"), F.min("version").alias("__version")))
    doc_id, version = docs[id_col].cast("long"), F.xxhash64(docs[text_col])

    kept = docs.join(heads, doc_id.eqNullSafe(heads["__id"]) & (version == heads["__version"]), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not _unordered(f.dataType)])
    one = kept.groupBy(F.col(id_col).cast("long").alias("__id"), F.xxhash64(F.col(text_col)).alias("__version"))
    return one.agg(F.min_by(row, order).alias("row")).select("row.*")


def _unordered(t: T.DataType) -> bool:
    return "map<" in t.simpleString() or "variant" in t.simpleString()
