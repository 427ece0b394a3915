"""Language-model scores: prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` long, held as tables of
grams (a context and the byte after it) with their counts in the training
texts. A byte that a context has seen n times of N, with q different bytes, has
probability n / (N + q) there; a byte it has not seen escapes with q / (N + q)
to the context that is one byte shorter, where bytes already ruled out are
left out of all counts (symbol exclusion), down to equal shares of the bytes
never seen at all. As a shorter context has seen all that a longer one has, the
bytes ruled out at a level are just those seen one level above, so the sums
left at each level follow from one aggregate per context.

Texts are read once into blocks of bounded size. A block's distinct grams and
words go out to be counted and scored, packed results come back to the block,
and each text is then summed up from the tables of its block. So what is
shuffled per word or gram is pre-aggregated by block, and no task needs the
whole model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .sampling import id_remainder
from .workers import send_code

ORDER = 4
#: Bytes that UTF-8 never uses stand before a text and at its end.
START, END = b"\xfe", b"\xff"
SYMBOLS = 256
BLOCK_BYTES = 32 << 20
_CHUNK = 4 << 20
_PACK = 400_000
#: Stands for the end token among words, which hold no white space.
_END_WORD = b"\n"
_TEXT, _GRAM, _WORD = 0, 1, 2
SMOOTHING = 0.1


def gram_codes(text: bytes, order: int) -> np.ndarray:
    """One number per byte of a text and its end: the byte and the ``order``
    bytes before it, the last byte lowest."""
    b = np.frombuffer(START * order + text + END, dtype=np.uint8)
    n = len(b) - order
    code = np.zeros(n, dtype=np.int64)
    for i in range(order + 1):
        code = (code << 8) | b[i:i + n]
    return code


class _Grams:
    """Counts of gram codes, merged as they come."""

    def __init__(self):
        self.codes, self.counts, self.waiting, self.size = [], [], [], 0

    def add(self, codes: np.ndarray) -> None:
        self.waiting.append(codes)
        self.size += len(codes)
        if self.size >= _CHUNK:
            self._settle()

    def _settle(self) -> None:
        if self.waiting:
            u, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.codes.append(u)
            self.counts.append(n.astype(np.int64))
            self.waiting, self.size = [], 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        self._settle()
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        return u, np.bincount(at, weights=np.concatenate(self.counts), minlength=len(u)).astype(np.int64)


def _part(block: int, kind: int, n_rows: int, id_type: pa.DataType, **columns) -> pa.RecordBatch:
    types = {"doc_id": id_type, "held_out": pa.bool_(), "text": pa.binary(), "gram": pa.int64(), "word": pa.binary(), "n": pa.int64()}
    arrays = [pa.array(np.full(n_rows, block)), pa.array(np.full(n_rows, kind, dtype=np.int32))]
    for name, t in types.items():
        c = columns.get(name)
        arrays.append(pa.nulls(n_rows, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t))
    return pa.RecordBatch.from_arrays(arrays, names=["block", "kind", *types])


def _blocks(order: int, block_bytes: int):
    """Texts as they are, and after the last text of a block its distinct
    grams and words with their counts in the texts to learn from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        id_type = None
        for k in numbers():
            grams, held, words, size, done = _Grams(), _Grams(), Counter(), 0, True
            for b in batches:
                id_type = b.column(0).type
                texts = [t.lower() for t in b.column(3).to_pylist()]
                yield _part(first + k, _TEXT, len(texts), id_type, doc_id=b.column(0), held_out=b.column(1), text=texts)
                for t, learn in zip(texts, b.column(2).to_pylist()):
                    if learn:
                        words.update(t.split())
                        words[_END_WORD] += 1
                        grams.add(gram_codes(t, order))
                    else:
                        words.update(dict.fromkeys(t.split(), 0))
                        words[_END_WORD] += 0
                        held.add(gram_codes(t, order))
                size += b.nbytes
                if size >= block_bytes:
                    done = False
                    break
            codes, counts = grams.total()
            others = np.setdiff1d(held.total()[0], codes, assume_unique=True)
            if len(codes) + len(others):
                codes, counts = np.concatenate([codes, others]), np.concatenate([counts, np.zeros(len(others), np.int64)])
                yield _part(first + k, _GRAM, len(codes), id_type, gram=codes, n=counts)
                names = list(words)
                for at in range(0, len(names), _PACK):
                    some = names[at:at + _PACK]
                    yield _part(first + k, _WORD, len(some), id_type, word=some, n=[words[w] for w in some])
            if done:
                return
    return run


def _suffix(order: int) -> Column:
    """The gram one byte shorter at the front: a byte and ``order`` before it."""
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def _context() -> Column:
    return F.shiftright("gram", 8)


def gram_scores(spark: SparkSession, grams: DataFrame, order: int, base: str) -> DataFrame:
    """``gram, x`` (log10 probability of a gram's last byte after the others)
    of every row of ``gram, n`` (distinct grams, n in the training texts)."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    grams = keep(grams, f"grams-{order}")
    seen = {order: grams.where("n > 0")}
    for k in range(order - 1, -1, -1):
        seen[k] = keep(seen[k + 1].select(_suffix(k).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n")), f"grams-{k}")
    # Per context of length k: total and kinds of what it has seen, and how
    # often the context one byte shorter has seen those same bytes.
    tries = {}
    for k in range(order, -1, -1):
        rows = seen[k].select(_context().alias("context"), "n", _suffix(k - 1).alias("short") if k else F.lit(0).alias("short"))
        if k:
            shorter = seen[k - 1].select(F.col("gram").alias("short"), F.col("n").alias("less"))
            rows = rows.join(shorter, "short")
        else:
            rows = rows.withColumn("less", F.lit(0).cast("long"))
        tries[k] = keep(rows.groupBy("context").agg(F.sum("n").alias(f"total{k}"), F.count("*").alias(f"kinds{k}"),
                                                    F.sum("less").alias(f"out{k}")), f"contexts-{k}")
    met = (seen[order].select("gram", "n", _context().alias("context")).join(tries[order], "context")
           .select("gram", F.log10(F.col("n") / (F.col(f"total{order}") + F.col(f"kinds{order}"))).alias("x")))
    new = grams.where("n = 0").select("gram")
    for k in range(order, -1, -1):
        new = new.withColumn("context", F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)), 8))
        new = new.join(tries[k], "context", "left").drop("context").na.fill(0, [f"total{k}", f"kinds{k}", f"out{k}"])
        if k < order:
            new = (new.withColumn("short", _suffix(k))
                   .join(seen[k].select(F.col("gram").alias("short"), F.col("n").alias(f"n{k}")), "short", "left").drop("short"))
    x, found = F.lit(0.0), F.lit(None).cast("double")
    for k in range(order, -1, -1):
        total = F.col(f"total{k}") - (F.col(f"out{k + 1}") if k < order else 0)
        kinds = F.col(f"kinds{k}") - (F.col(f"kinds{k + 1}") if k < order else 0)
        if k < order:
            found = F.coalesce(found, F.when(F.col(f"n{k}").isNotNull(), x + F.log10(F.col(f"n{k}") / (total + kinds))))
        x = x + F.when(kinds > 0, F.log10(kinds / (total + kinds))).otherwise(0.0)
    return met.unionByName(new.select("gram", F.coalesce(found, x - F.log10(SYMBOLS - F.col("kinds0"))).alias("x")))


def _squeeze(*arrays: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(b"".join([len(a).to_bytes(8, "little") for a in arrays] + list(arrays)))


def _unsqueeze(blob: bytes, n: int) -> list[bytes]:
    import zstandard
    data, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 8 * n
    for i in range(n):
        size = int.from_bytes(data[8 * i:8 * i + 8], "little")
        out.append(data[at:at + size])
        at += size
    return out


_PACKED = "block long, kind int, blob binary, fresh long"


def _packer(kind: int):
    """``block, key, value, fresh`` rows as few rows per block: keys and values
    of a block together, squeezed."""
    def one(pending: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(pending)
        block = t.column(0).to_numpy()
        order = np.argsort(block, kind="stable")
        values, fresh = t.column(2).to_numpy()[order], t.column(3).to_numpy()[order].astype(np.int64)
        block = block[order]
        if kind == _GRAM:
            keys = t.column(1).to_numpy()[order]
        else:
            plain = t.column(1).to_pylist()
            keys = [plain[i] for i in order.tolist()]
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        blobs, sums = [], []
        for a, z in zip(cuts, cuts[1:]):
            ks = keys[a:z].tobytes() if kind == _GRAM else b" ".join(keys[a:z])
            blobs.append(_squeeze(ks, values[a:z].tobytes()))
            sums.append(int(fresh[a:z].sum()))
        return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array(np.full(len(blobs), kind, dtype=np.int32)),
                                           pa.array(blobs, pa.binary()), pa.array(sums, pa.int64())],
                                          names=["block", "kind", "blob", "fresh"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, n = [], 0
        for b in batches:
            pending.append(b)
            n += b.num_rows
            if n >= _PACK:
                yield one(pending)
                pending, n = [], 0
        if n:
            yield one(pending)
    return run


def _scorer(order: int):
    """Sums of every text, from the tables of its block (which come first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, xs, words, table = None, [], [], {}, None
        for b in batches:
            out: list[tuple] = []
            blocks, kinds = b.column(0).to_pylist(), b.column(1).to_pylist()
            ids, held, blobs = b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4)
            for i, (k, kind) in enumerate(zip(blocks, kinds)):
                if k != block:
                    block, keys, xs, words, table = k, [], [], {}, None
                blob = blobs[i].as_py()
                if kind == _GRAM:
                    a, x = _unsqueeze(blob, 2)
                    keys.append(np.frombuffer(a, np.int64))
                    xs.append(np.frombuffer(x, np.float64))
                elif kind == _WORD:
                    a, n = _unsqueeze(blob, 2)
                    words.update(zip(a.split(b" "), np.frombuffer(n, np.int64).tolist()))
                else:
                    if table is None:
                        gram, x = np.concatenate(keys), np.concatenate(xs)
                        at = np.argsort(gram)
                        table, keys, xs = (gram[at], x[at]), [], []
                    codes = np.sort(gram_codes(blob, order))
                    score = float(table[1][np.searchsorted(table[0], codes)].sum())
                    ns = np.array([*map(words.__getitem__, blob.split()), words[_END_WORD]], dtype=np.int64)
                    out.append((ids[i], held[i], len(ns), int((ns > 0).sum()), float(np.log10(ns + SMOOTHING).sum()), score))
            if out:
                kinds_out = (b.column(2).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds_out)],
                                                 names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])
    return run


def score_texts(spark: SparkSession, docs: DataFrame, *, order: int = ORDER, one_in: int = 10, id_col: str = "doc_id",
                text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every row.

    Learns from rows whose ``crc32(id as text)`` is no multiple of ``one_in``;
    the others are held out. Texts have A-Z lower-cased. ``base_score`` is the
    smoothed log10 probability of the words and the end under word counts,
    ``score`` the model's of all bytes of the text and its end. Null texts
    count as empty. Rows without an id are scored, not learned from and not
    held out. Repeated rows are each learned from and scored. Very long texts
    are one row of a block. Without rows to learn from, all bytes are equally
    likely; an empty table gives no rows. Other columns may have any name.
    """
    if not 1 <= order <= 6:
        raise ValueError("contexts are 1 to 6 bytes long")
    send_code(spark)
    base = scratch_dir(spark, "lm")
    left = id_remainder(id_col, one_in)
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(left == 0, F.lit(False)).alias("held_out"),
                    F.coalesce(left != 0, F.lit(False)).alias("learn"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    parts_of = f"block long, kind int, doc_id {id_type}, held_out boolean, text binary, gram long, word binary, n long"
    d.mapInArrow(_blocks(order, block_bytes), parts_of).write.option("compression", "zstd").parquet(f"{base}/parts")
    parts = spark.read.schema(parts_of).parquet(f"{base}/parts")

    by_block = parts.where(F.col("kind") == _GRAM).select("block", "gram", "n")
    scores = gram_scores(spark, by_block.groupBy("gram").agg(F.sum("n").alias("n")), order, base)
    grams = (by_block.select("block", "gram").join(scores, "gram").select("block", "gram", "x", F.lit(False))
             .mapInArrow(_packer(_GRAM), _PACKED))

    # A word has at most one row per block here.
    words = parts.where(F.col("kind") == _WORD).select("block", "word", "n")
    everywhere = Window.partitionBy("word")
    n = F.sum("n").over(everywhere)
    words.select("block", "word", n.alias("n"), ((F.min("block").over(everywhere) == F.col("block")) & (n > 0)).alias("fresh")
                 ).mapInArrow(_packer(_WORD), _PACKED).write.parquet(f"{base}/words")
    packed = spark.read.schema(_PACKED).parquet(f"{base}/words")
    distinct = packed.agg(F.sum("fresh")).first()[0] or 0
    total = words.agg(F.sum("n")).first()[0] or 0

    none = [F.lit(None).cast(id_type).alias("doc_id"), F.lit(None).cast("boolean").alias("held_out")]
    tables = grams.unionByName(packed).select("block", "kind", *none, "blob")
    texts = parts.where(F.col("kind") == _TEXT).select("block", "kind", "doc_id", "held_out", F.col("text").alias("blob"))
    scored = (tables.unionByName(texts).repartition("block").sortWithinPartitions("block", F.col("kind").desc())
              .mapInArrow(_scorer(order), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, logs double, score double"))
    share = float(np.log10(total + SMOOTHING * (distinct + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * F.lit(share)).alias("base_score"), "score")
