"""Token ids in a compressed binary store with short-document access.

Format, a folder with two Parquet tables (so that any file system Spark can
write works, and a lost task or executor never leaves half a file):

``dictionary``  one row: ``sha256`` and ``content`` of the shared zstandard
                dictionary, trained on serialized id arrays.
``blocks``      one row for a run of documents in ascending id order:
                ``part, block``      place in the order,
                ``dictionary``       sha256 of the dictionary it needs,
                ``doc_ids``          ids of its documents,
                ``n_tokens``         tokens of each document,
                ``offsets``          where each document's frame starts in
                                     ``payload`` (one more: the end),
                ``payload``          one zstandard frame a document; the frame
                                     holds its ids as little-endian unsigned
                                     32-bit integers, the end id included.

Each document is a frame of its own, so reading one short document decodes
that frame alone; the shared dictionary is what keeps short frames small.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import PieceEncoder, load_tokenizer, read_spec, worker_encoder
from .workers import send_code

TRAIN_DOCS = 1000
TRAIN_BYTES = 1 << 14
DICT_BYTES = 1 << 16
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 4096
LEVEL = 3
_TOGETHER = 256

BLOCK_SCHEMA = ("part int, block int, dictionary string, doc_ids array<bigint>, n_tokens array<bigint>, "
                "offsets array<bigint>, payload binary")


def _id_encoder(spec: str, rule: str) -> PieceEncoder:
    import numpy as np
    tok = load_tokenizer(spec)

    def encode(pieces):
        if rule != "drop":
            return [np.array(e.ids, dtype="<u4").tobytes() for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]
        # White space is dropped, so pieces can go together, and a token
        # belongs to the piece that its place in the text falls into.
        out = []
        for at in range(0, len(pieces), _TOGETHER):
            some = pieces[at:at + _TOGETHER]
            e = tok.encode(" ".join(some), add_special_tokens=False)
            size = np.array([len(p) + 1 for p in some])
            cut = np.searchsorted(np.array([o[0] for o in e.offsets], dtype=np.int64), np.cumsum(size) - size).tolist()
            raw = np.array(e.ids, dtype="<u4").tobytes()
            out += [raw[4 * i:4 * j] for i, j in zip(cut, [*cut[1:], len(e.ids)])]
        return out
    return worker_encoder(("ids", spec, rule), lambda: PieceEncoder(encode, rule))


def _slices(ids: bytes, most: int, n: int = 4) -> bytes:
    """At most ``most`` bytes of serialized ids: all of them, or slices of
    whole ids spread evenly from the first to the last."""
    if len(ids) <= most:
        return ids
    size = most // n // 4 * 4
    step = (len(ids) - size) // 4 / (n - 1)
    return b"".join(ids[int(k * step) * 4:int(k * step) * 4 + size] for k in range(n))


def train_dictionary(docs: DataFrame, spec, rule: str, *, sample: int = TRAIN_DOCS,
                     sample_bytes: int = TRAIN_BYTES, dict_bytes: int = DICT_BYTES) -> bytes:
    """Shared dictionary from about ``sample`` documents picked by a hash of
    id and text (rows equal in both are one), at most ``sample_bytes`` of
    serialized ids from each, spread over the whole document. Too few or too
    small samples to train on give their bytes as a raw dictionary, no text at
    all an empty one."""
    n = docs.count()
    share = max(1, -(-n // sample))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("dictionary")), F.lit(share)) == 0).distinct()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _id_encoder(spec.value, rule)
        for b in batches:
            out = [_slices(b"".join(v), sample_bytes) for v in enc.many([t or "" for t in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    import zstandard
    rows = sorted(bytes(r.ids) for r in picked.mapInArrow(ids, "ids binary").where(F.octet_length("ids") > 0).collect())
    try:
        return zstandard.train_dictionary(dict_bytes, rows).as_bytes()
    except zstandard.ZstdError:
        return b"".join(rows)[:dict_bytes]


def _zstd_dictionary(content: bytes):
    import zstandard
    if not content:
        return None
    kind = (zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressionDict(content, dict_type=kind)


def write_token_store(spark: SparkSession, docs: DataFrame, tokenizer_path: str, path: str, *, end_id: int,
                      rule: str = "drop", id_col: str = "doc_id", text_col: str = "text",
                      block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> None:
    """Encodes every document (null text: empty), appends ``end_id`` and
    writes the store in ascending id order (null ids first, repeated ids next
    to each other). An empty table gives a store without blocks."""
    send_code(spark)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    content = train_dictionary(d, spec, rule)
    sha = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(sha, bytearray(content))], "sha256 string, content binary").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(content)
    end = int(end_id).to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        enc = _id_encoder(spec.value, rule)
        zd = _zstd_dictionary(shared.value)
        if zd is not None:
            zd.precompute_compress(level=LEVEL)
            packer = zstandard.ZstdCompressor(dict_data=zd)
        else:
            packer = zstandard.ZstdCompressor(level=LEVEL)
        part, block = TaskContext.get().partitionId(), 0
        ids, counts, offsets, frames = [], [], [0], []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([sha]),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([offsets], pa.list_(pa.int64())), pa.array([b"".join(frames)], pa.binary())],
                names=["part", "block", "dictionary", "doc_ids", "n_tokens", "offsets", "payload"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), enc.many([t or "" for t in b.column(1).to_pylist()])):
                raw = b"".join(v) + end
                frame = packer.compress(raw)
                ids.append(i)
                counts.append(len(raw) // 4)
                offsets.append(offsets[-1] + len(frame))
                frames.append(frame)
                if offsets[-1] >= block_bytes or len(ids) >= block_docs:
                    yield flush()
                    block += 1
                    ids, counts, offsets, frames = [], [], [0], []
        if ids:
            yield flush()

    # The order of equal ids is free, so ranges may cut between them.
    ranged = d.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    (ranged.repartitionByRange("doc_id", "hash", "row").select("doc_id", "text").sortWithinPartitions("doc_id").mapInArrow(blocks, BLOCK_SCHEMA)
     .write.mode("overwrite").parquet(f"{path}/blocks"))


def _unpacker(content: bytes):
    import zstandard
    zd = _zstd_dictionary(content)
    return zstandard.ZstdDecompressor(dict_data=zd) if zd is not None else zstandard.ZstdDecompressor()


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    content = bytes(row.content)
    if hashlib.sha256(content).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary in {path} does not match its hash")
    return row.sha256, content


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, from
    the decoded frames. ``start`` counts the ids of all documents before it."""
    send_code(spark)
    sha, content = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(content)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(shared.value)
        for b in batches:
            for part, block, used, ids, offsets, payload in zip(*(c.to_pylist() for c in b.columns)):
                if used != sha:
                    raise ValueError(f"block {part}/{block} needs dictionary {used}")
                raws = [unpack.decompress(payload[x:y]) for x, y in zip(offsets, offsets[1:])]
                counts = [len(r) // 4 for r in raws]
                local, at = [], 0
                for c in counts:
                    local.append(at)
                    at += c
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(ids, pa.int64()),
                     pa.array(local, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([zlib.crc32(r) for r in raws], pa.int64())],
                    names=["part", "block", "doc_id", "local", "n_tokens", "ids_crc32"])

    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    rows = stored.select("part", "block", "dictionary", "doc_ids", "offsets", "payload").mapInArrow(
        digest, "part int, block int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return (rows.join(_block_starts(stored), ["part", "block"])
            .select("doc_id", (F.col("start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def _block_starts(stored: DataFrame) -> DataFrame:
    """Ids before each block: starts of the parts (one row a written
    partition), then of the blocks inside each part."""
    sizes = stored.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select("part", F.coalesce(F.sum("n").over(over_parts), zero).alias("before"))
    inside = sizes.select("part", "block", F.coalesce(F.sum("n").over(over_blocks), zero).alias("inside"))
    return inside.join(parts, "part").select("part", "block", (F.col("before") + F.col("inside")).alias("start"))


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents. Only blocks that hold one of them
    are opened, and only the frames asked for are decoded."""
    send_code(spark)
    _, content = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(content)
    wanted = sorted(set(doc_ids))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        unpack, want = _unpacker(shared.value), set(wanted)
        for b in batches:
            for ids, offsets, payload in zip(*(c.to_pylist() for c in b.columns)):
                hit = [(i, x, y) for i, x, y in zip(ids, offsets, offsets[1:]) if i in want]
                out = [np.frombuffer(unpack.decompress(payload[x:y]), "<u4").astype("i8") for _, x, y in hit]
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hit], pa.int64()),
                                                  pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    asked = F.array(*[F.lit(i).cast("long") for i in wanted])
    return (stored.where(F.arrays_overlap("doc_ids", asked)).select("doc_ids", "offsets", "payload")
            .mapInArrow(pick, "doc_id long, ids array<bigint>"))
