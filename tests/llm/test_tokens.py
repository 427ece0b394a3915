"""Operators 2, 4 and 8 against the tokenizers library."""

import random
from functools import lru_cache

import numpy as np
import pytest
from brute import ids_crc32, sha
from tokenizers import Tokenizer

from tidemark.llm.bpe import Merger, decode_documents, encode_documents, frequent_words, round_trip_digests
from tidemark.llm.pieces import PieceEncoder, read_spec
from tidemark.llm.queries import tokenizer
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.token_store import read_documents, read_token_digests, train_dictionary, write_token_store
from tidemark.llm.transducer import Transducer, compile_transducer

BYTE, WORD = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")
ODD = ["a", "b", "The", " ", "  ", "\n", "\t", "\xa0", "\x85", "\x1c", " ", "　", "!", "...", "'s", "'ll", "7", "é", "Σ",
       "é", "漢", "<|endoftext|>", "<|startoftext|>", "😀", "\r\n", "\x0b", "﻿", "x" * 60, "¼", "٣", "ſ"]


library = lru_cache(Tokenizer.from_file)


def ids(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("path,rule", [(BYTE, "keep"), (WORD, "drop")])
def test_pieces_encode_as_whole_texts(path, rule):
    tok = Tokenizer.from_file(path)
    enc = PieceEncoder(lambda ps: [e.ids for e in tok.encode_batch(ps, add_special_tokens=False)], rule, batch_bytes=20, max_pieces=50)
    for t in odd_texts(4000, 1):
        assert [i for v in enc(t) for i in v] == tok.encode(t, add_special_tokens=False).ids, t


def test_merger_equals_library_and_decodes_back():
    tok, m = Tokenizer.from_file(BYTE), Merger(read_spec(BYTE))
    for t in odd_texts(4000, 2) + ["ab" * 5000, "a" * 3001]:
        want = tok.encode(t, add_special_tokens=False).ids
        assert list(m.encode(t)) == want, t
        assert m.decode(want) == tok.decode(want, skip_special_tokens=False)
    broken = [m.of_byte[b] for b in (0xE2, 0x82, 0x41)]
    assert m.decode(broken) == tok.decode(broken, skip_special_tokens=False)


def test_many_words_merge_as_one_by_one():
    m, r = Merger(read_spec(BYTE)), random.Random(4)
    words = ["".join(r.choice("aeinrst hxq'é漢") for _ in range(r.randint(1, 60))).encode() for _ in range(3000)]
    words += [bytes(r.randrange(256) for _ in range(r.randint(1, 9))) for _ in range(2000)] + [b"a" * n for n in range(1, 70)]
    want = [m.merge(w) for w in words]
    assert [np.frombuffer(x, m.id_type).tolist() for x in m.merge_many(words)] == want
    texts = odd_texts(500, 3) + ["".join(r.choice("aéßÿĀɏ×÷.,'7 \n") for _ in range(r.randint(1, 12))) for _ in range(500)]
    tok = Tokenizer.from_file(BYTE)
    for t, x in zip(texts, m.encode_many(texts)):
        ids = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(x, m.id_type).tolist() == ids
        assert m.digests(x) == (len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
    assert m.merge_many([]) == [] and m.digests(b"") == (0, sha(""), sha(""))


@pytest.mark.parametrize("rule", ["keep", "drop"])
def test_batches_are_balanced_by_bytes(rule):
    """Short texts share a batch, long ones are split, and no batch is larger
    than its size and one piece."""
    r = random.Random(9)
    texts = [" ".join("né" * r.randint(1, 6) for _ in range(r.choice([1, 5, 3000]))) for _ in range(60)] + ["", " "]
    enc = PieceEncoder(lambda ps: ps, rule, batch_bytes=4000)
    sizes = [sum(len(p.encode()) + 1 for p in [*pieces, *(f for _, f in firsts)]) for firsts, pieces, _ in enc.batches(texts)]
    assert len(sizes) > 10 and max(sizes) <= 4000 + 60 and min(sizes[:-1]) >= 4000 - 60 * 2
    assert sum(sizes) <= sum(len(t.encode()) + 2 for t in texts)


def test_frequent_pieces_stay_known():
    """New pieces come without end; those that keep coming back are encoded a
    bounded number of times, and the tables stay within their size."""
    asked = []
    enc = PieceEncoder(lambda ps: asked.extend(ps) or ps, "drop", batch_bytes=1, max_pieces=40)
    for i in range(500):
        late = ["late"] if i > 100 else []
        assert enc(" ".join(["the", f"rare{i}", "of", *late])) == ["the", f"rare{i}", "of", *late]
    assert asked.count("the") == asked.count("of") == asked.count("late") == 1
    known = enc.rest
    assert len(known.first) + len(known.young) + len(known.old) <= 40 and "late" not in known.first


def test_slices_are_spread_over_a_document():
    from tidemark.llm.token_store import _slices
    ids = b"".join(i.to_bytes(4, "little") for i in range(1000))
    part = np.frombuffer(_slices(ids, 400), "<u4")
    assert len(part) == 100 and part[0] == 0 and part[-1] == 999 and _slices(ids, 4000) == ids
    assert (np.diff(part) > 1).sum() == 3


def test_pieces_encoded_together_are_as_one_by_one():
    from tidemark.llm.token_store import _id_encoder
    enc, tok = _id_encoder(read_spec(WORD), "drop"), Tokenizer.from_file(WORD)
    pieces = [p for t in odd_texts(3000, 5) for p in t.split()] + ["x" * 5000]
    for p, v in zip(pieces, enc.encode(pieces)):
        assert np.frombuffer(v, "<u4").tolist() == tok.encode(p, add_special_tokens=False).ids, p


def test_transducer_is_exact_and_shares_suffixes(tmp_path):
    words = {w.encode(): tuple(range(i % 4)) for i, w in enumerate(
        [f"{a}{b}" for a in ("", "re", "un", "über", "漢") for b in ("do", "doing", "done", "make", "making", "")])}
    blob = compile_transducer(words)
    (tmp_path / "f").write_bytes(blob)
    for t in (Transducer(blob), Transducer(str(tmp_path / "f"))):
        assert {w: t.get(w) for w in words} == words
        assert all(t.get(w + x) is None for w in words for x in (b"x", b"\xff") if w + x not in words)
        assert [t.place(w) for w in sorted(words)] == list(range(len(words)))
        asked = [*words, b"redoX", b"x", b"reundo", "über".encode()[:2], b""]
        assert t.places(asked).tolist() == [t.place(w) for w in asked]
        assert t.n_states < sum(map(len, words)) / 2
    none = Transducer(compile_transducer({}))
    assert none.get(b"a") is None and none.places([b"a", b""]).tolist() == [-1, -1]


def test_counts(spark, edge_docs, edge_rows, no_docs):
    got = sorted((tuple(r) for r in count_tokens(spark, edge_docs, BYTE, limit=50).collect()), key=str)
    want = [(d, len((t or "").encode()), n := len(ids(BYTE, t)), n > 50) for d, t, *_ in edge_rows]
    assert got == sorted(want, key=str)
    assert count_tokens(spark, no_docs, BYTE).count() == 0


def test_round_trip(spark, edge_docs, edge_rows, no_docs):
    got = sorted((tuple(r) for r in round_trip_digests(spark, edge_docs, BYTE, one_in=64).collect()), key=str)
    want = [(d, len(i := ids(BYTE, t)), sha(",".join(map(str, i))), sha(t or "")) for d, t, *_ in edge_rows]
    assert got == sorted(want, key=str)
    assert round_trip_digests(spark, no_docs, BYTE).count() == 0
    encoded = encode_documents(spark, edge_docs.where("doc_id < 10"), BYTE)
    texts = {(r.doc_id, r.text) for r in decode_documents(spark, encoded, BYTE).collect()}
    assert texts == {(d, t or "") for d, t, *_ in edge_rows if d is not None and d < 10}


def test_words_that_reach_the_driver_are_bounded_in_bytes(spark):
    texts = ["a" * 255 + " x", "a" * 256 + " x", "漢" * 85 + " x", "漢" * 86 + " x", "漢字" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.word for r in frequent_words(docs).collect()} == {"x", "a" * 255, "漢" * 85}
    got = {r.doc_id: r.ids for r in encode_documents(spark, docs, BYTE).collect()}
    assert got == {i: ids(BYTE, t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("block_docs", [3, 4096])
def test_token_store(spark, workdir, edge_docs, edge_rows, block_docs):
    rows = [r for r in edge_rows if r[0] != 1 or r[1]]
    write_token_store(spark, edge_docs, WORD, workdir, end_id=1, block_docs=block_docs, block_bytes=1 << 12)
    got = [tuple(r) for r in read_token_digests(spark, workdir).orderBy("start").collect()]
    want = sorted(((d, len(i := ids(WORD, t) + [1]), ids_crc32(i)) for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted(((g[0], g[2], g[3]) for g in got), key=str) == sorted(want, key=str)
    at = 0
    for g in got:
        assert g[1] == at
        at += g[2]
    few = {r.doc_id: r.ids for r in read_documents(spark, workdir, [3, 14, 99_999]).collect()}
    assert few == {3: [1], 14: ids(WORD, dict((r[0], r[1]) for r in rows)[14]) + [1]}


def test_token_store_without_documents_and_with_a_foreign_dictionary(spark, workdir, no_docs, edge_docs):
    write_token_store(spark, no_docs, WORD, f"{workdir}/none", end_id=1)
    assert read_token_digests(spark, f"{workdir}/none").count() == 0
    write_token_store(spark, edge_docs.where("doc_id < 6"), WORD, f"{workdir}/a", end_id=1)
    write_token_store(spark, edge_docs.where("doc_id > 6"), WORD, f"{workdir}/b", end_id=1)
    spark.read.parquet(f"{workdir}/b/dictionary").write.parquet(f"{workdir}/mixed/dictionary")
    spark.read.parquet(f"{workdir}/a/blocks").write.parquet(f"{workdir}/mixed/blocks")
    with pytest.raises(Exception, match="needs dictionary"):
        read_token_digests(spark, f"{workdir}/mixed").collect()


def test_a_dictionary_is_trained_where_samples_allow_it(spark):
    from tidemark.tables import load
    docs = load(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    spec = spark.sparkContext.broadcast(read_spec(WORD))
    assert train_dictionary(docs, spec, "drop")[:4] == b"\x37\xa4\x30\xec"


def test_a_repeated_id_fills_many_ranges(spark, workdir, monkeypatch):
    """A third of the rows share an id: no range holds them all, and the store
    still counts up in id order."""
    from tidemark.llm import token_store
    monkeypatch.setattr(token_store, "train_dictionary", lambda *a, **kw: b"")
    rows = [(i, f"text number {i}") for i in range(1000)] + [(500, f"other {i % 3}") for i in range(500)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_token_store(spark, d, WORD, workdir, end_id=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [len(r.doc_ids) for r in spark.read.parquet(f"{workdir}/blocks").collect()]
    assert len(sizes) >= 6 and max(sizes) < 400
    got = [tuple(r) for r in read_token_digests(spark, workdir).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted(i for i, _ in rows)
    assert sorted((g[0], g[2]) for g in got) == sorted((i, len(ids(WORD, t)) + 1) for i, t in rows)
