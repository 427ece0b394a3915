"""BPE encoding and decoding with a transducer lexicon.

Frequent words are compiled with their ids into a minimal acyclic transducer
that every worker maps into memory. A word that is not in it is merged pair by
pair, by the same rules, so ids never depend on what the lexicon holds.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import PieceEncoder, load_tokenizer, read_spec, worker_encoder
from .transducer import Transducer, compile_transducer
from .workers import send_code, send_file

#: A word is frequent if it makes up at least one in so many of all words, so
#: a lexicon never has more words than this.
ONE_IN = 1 << 17
#: Longer words are merged where they occur, so the words that reach the
#: driver have at most ONE_IN times so many bytes.
MAX_WORD = 255
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: The same where all other characters are letters of the Latin blocks.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LATIN = re.compile(rf"[\x00-\x7f{_LETTERS}]*")
_LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+", re.ASCII)
_LONG = 48


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merger:
    """Exact byte-level BPE of single pieces, and decoding."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        vocab = doc["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        self.library = load_tokenizer(spec)
        self.of_byte = [vocab[alphabet[b]] for b in range(256)]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in doc["model"]["merges"]]
        self.rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.joined = [vocab[a + b] for a, b in pairs]
        self.no_rank = len(pairs)
        self.special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        #: Array type that holds every id.
        self.id_type = np.dtype("<u2" if max(self.bytes_of, default=0) < 1 << 16 else "<u4")
        # The same tables as arrays: ids of bytes, and pairs sorted by number
        # with their ranks. Rank `no_rank` stands for a pair that never joins.
        self.byte_ids = np.array(self.of_byte, dtype=np.int64)
        number = np.array([(a << 32) | b for a, b in self.rank_of] or [-1], dtype=np.int64)
        at = np.argsort(number)
        self.pair_keys = number[at]
        self.pair_ranks = np.array([*self.rank_of.values()] or [0], dtype=np.int64)[at]
        self.joined_ids = np.array([*self.joined, 0], dtype=np.int64)
        self.token_bytes = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=0) + 1)]
        #: Decimal digits and a comma of every id, in eight bytes filled up with zeros.
        self.decimals = np.array([f"{i},".encode() for i in range(len(self.token_bytes))], dtype="S8").view("<u8")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def words(self, text: str) -> list[bytes]:
        """Words the pre-tokenizer makes of a piece without special tokens."""
        if text.isascii():
            return [w.encode() for w in _ASCII_WORDS.findall(text)]
        if _LATIN.fullmatch(text):
            return [w.encode() for w in _LATIN_WORDS.findall(text)]
        return [text[a:b].encode() for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: always joins the pair of lowest rank, the leftmost
        of equal ones."""
        ids = [self.of_byte[b] for b in word]
        if len(ids) > _LONG:
            return self._merge_long(ids)
        rank, joined, none = self.rank_of.get, self.joined, self.no_rank
        ranks = [rank(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at:at + 2] = [joined[best]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), none)
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for long words."""
        n, rank, joined = len(ids), self.rank_of.get, self.joined
        right, left = list(range(1, n)) + [-1], list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (r := rank((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = right[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = joined[best], -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [x for x in ids if x >= 0]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == pair, self.pair_ranks[at], self.no_rank)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many words, by the rule of ``merge``. Words of one
        length are the rows of a table; every round joins one pair in each row,
        so rows stay equally long, and a row without a pair to join is done."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, places in by_length.items():
            if n > _LONG or len(places) < 8:
                for i in places:
                    out[i] = np.array(self.merge(words[i]), dtype=self.id_type).tobytes()
                continue
            row = np.array(places)
            ids = self.byte_ids[np.frombuffer(b"".join([words[i] for i in places]), dtype=np.uint8)].reshape(-1, n)
            ranks = self._ranks(ids[:, :-1], ids[:, 1:])
            while len(row):
                m = ids.shape[1]
                best = ranks.min(axis=1) if m > 1 else np.full(len(row), self.no_rank)
                done = best == self.no_rank
                if done.any():
                    size = m * self.id_type.itemsize
                    raw = ids[done].astype(self.id_type).tobytes()
                    for k, i in enumerate(row[done].tolist()):
                        out[i] = raw[k * size:(k + 1) * size]
                    row, ids, ranks, best = row[~done], ids[~done], ranks[~done], best[~done]
                    if not len(row):
                        break
                at = ranks.argmin(axis=1)
                every = np.arange(len(row))
                cols = np.arange(m - 1)
                ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
                ids[every, at] = self.joined_ids[best]
                if m > 2:
                    cols = cols[:-1]
                    ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), 1)
                    left, right = at > 0, at < m - 2
                    r, c = every[left], at[left]
                    ranks[r, c - 1] = self._ranks(ids[r, c - 1], ids[r, c])
                    r, c = every[right], at[right]
                    ranks[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of pieces; each different word in them is merged once."""
        words: dict[bytes, int] = {}
        plans = []
        cut = self.cut if self.cut and self.cut.search("\n".join(texts)) else None
        for t in texts:
            plan = []
            for part in cut.split(t) if cut else (t,):
                if part in self.special:
                    plan.append(self.special[part].to_bytes(self.id_type.itemsize, "little"))
                elif part:
                    plan += [words.setdefault(w, len(words)) for w in self.words(part)]
            plans.append(plan)
        packed = self.merge_many(list(words))
        return [b"".join([x if type(x) is bytes else packed[x] for x in plan]) for plan in plans]

    def encode(self, text: str) -> tuple[int, ...]:
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for w in self.words(part):
                    out.extend(self.merge(w))
        return tuple(out)

    def decode(self, ids) -> str:
        """The text of ids; special tokens are kept, ids without a token are
        skipped, broken UTF-8 becomes the replacement character."""
        table = self.token_bytes
        return b"".join([table[i] for i in ids if 0 <= i < len(table)]).decode("utf-8", "replace")

    def digests(self, packed: bytes) -> tuple[int, str, str]:
        """Number of ids, and sha256 of their decimals joined by commas and of
        their text."""
        ids = np.frombuffer(packed, self.id_type)
        digits = self.decimals[ids].view(np.uint8)
        digits = digits[digits != 0][:-1].tobytes()
        text = b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return len(ids), hashlib.sha256(digits).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


_MERGERS: dict[int, Merger] = {}
_MAPPED: dict[str, Transducer] = {}


def merger(spec: str) -> Merger:
    if hash(spec) not in _MERGERS:
        _MERGERS[hash(spec)] = Merger(spec)
    return _MERGERS[hash(spec)]


def frequent_words(docs: DataFrame, one_in: int = ONE_IN, *, text_col: str = "text") -> DataFrame:
    """``word, n``: space-separated words of at most ``MAX_WORD`` bytes that
    make up at least one in ``one_in`` of all words of all texts. There are at
    most ``one_in``."""
    words = docs.select(F.explode(F.split(F.col(text_col), " ")).alias("word"))
    n_words = docs.agg(F.coalesce(F.sum(F.length(text_col) - F.length(F.replace(text_col, F.lit(" "), F.lit(""))) + 1),
                                  F.lit(0)).alias("n")).first()["n"]
    return (words.where((F.col("word") != "") & (F.octet_length("word") <= MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") * one_in >= n_words))


def build_lexicon(docs: DataFrame, spec: str, one_in: int = ONE_IN, *, text_col: str = "text") -> bytes:
    """Compiled transducer of the frequent words, each with the space before
    it. An empty corpus gives an automaton without words."""
    m = merger(spec)
    rows = frequent_words(docs, one_in, text_col=text_col).select("word").collect()
    return compile_transducer({w: m.encode(w.decode()) for w in (b" " + r.word.encode() for r in rows)})


def lexicon_encoder(spec: str, file_name: str) -> PieceEncoder:
    """Encoder for a worker: looks a piece up in the mapped transducer and
    merges what is not there. Values are packed ids (see ``id_type``), which
    leaves room for many known pieces."""
    m = merger(spec)
    if file_name not in _MAPPED:
        _MAPPED[file_name] = Transducer(SparkFiles.get(file_name))
    lexicon = _MAPPED[file_name]
    ids, start = np.frombuffer(lexicon.ids, dtype="<u4"), lexicon.id_start

    def encode(pieces):
        places = lexicon.places([p.encode() for p in pieces]).tolist()
        out = [None if k < 0 else ids[start[k]:start[k + 1]].astype(m.id_type).tobytes() for k in places]
        rest = [i for i, v in enumerate(out) if v is None]
        for i, v in zip(rest, m.encode_many([pieces[i] for i in rest])):
            out[i] = v
        return out
    return worker_encoder((spec, file_name), lambda: PieceEncoder(encode, "keep"))


def _prepare(spark: SparkSession, docs: DataFrame, tokenizer_path: str, one_in: int):
    send_code(spark)
    spec = read_spec(tokenizer_path)
    return spark.sparkContext.broadcast(spec), send_file(spark, "lexicon.fst", build_lexicon(docs, spec, one_in))


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, *, one_in: int = ONE_IN,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row, as the library encodes the whole text
    without adding special tokens (null text: no ids)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spec, lexicon = _prepare(spark, d, tokenizer_path, one_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, enc = merger(spec.value), lexicon_encoder(spec.value, lexicon)
        for b in batches:
            ids = [np.frombuffer(b"".join(v), m.id_type).tolist() for v in enc.many([t or "" for t in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return d.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(spark: SparkSession, encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, text`` of rows of ``doc_id, ids`` (null ids: empty text)."""
    send_code(spark)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(spec.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.decode(x.as_py() or ()) for x in b.column(1)], pa.string())],
                names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(spark: SparkSession, docs: DataFrame, tokenizer_path: str, *, one_in: int = ONE_IN,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encodes
    the whole text (null: empty), decodes the ids, and returns digests. Very
    long texts and words, repeated rows and other columns of any name are
    fine; an empty table gives no rows. Ids must be integers (or cast to them)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spec, lexicon = _prepare(spark, d, tokenizer_path, one_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, enc = merger(spec.value), lexicon_encoder(spec.value, lexicon)
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for v in enc.many([t or "" for t in b.column(1).to_pylist()]):
                n, ids, text = m.digests(b"".join(v))
                counts.append(n)
                ids_sha.append(ids)
                text_sha.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
