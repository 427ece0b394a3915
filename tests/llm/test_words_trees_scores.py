"""Operators 11 to 13 against brute force."""

import random

import numpy as np
import pytest
from brute import Ppm, lm, merkle, spelling, spelling_forms

from tidemark.llm import lm_scoring as L
from tidemark.llm import merkle as M
from tidemark.llm import spelling as S
from tidemark.session import scratch_dir
from tidemark.tables import load

SF001 = "/root/testdata/sf0.001"


def _noisy_words(r, n):
    """Words around a few stems, many within one letter of others."""
    out = set()
    while len(out) < n:
        w = list(r.choice(["wörter", "anagram", "nagaram", "letters", "settler", "trestle", "aaaaa", "aaaaab"]))
        for _ in range(r.randint(0, 3)):
            i, c = r.randrange(len(w)), r.choice("abelnrstöÿ×")
            w[i:i + r.randint(0, 1)] = [c] if r.random() < 0.7 else []
        if len(w) >= 5:
            out.add("".join(w))
    return sorted(out)


@pytest.mark.parametrize("cap", [1, 2, 7, 4096])
def test_near_words_at_every_cap(spark, cap):
    """Small caps split the trie to its leaves and send crowded leaves over
    the keys with a gap; the result never changes."""
    r = random.Random(cap)
    words = [*_noisy_words(r, 500), "z" * 300, "z" * 301, "z" * 299 + "q", "q" + "z" * 300, "y" * 300]
    n = {w: r.choice([3, 4, 9, 20, 50]) for w in words}
    rows = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    found = {x.word: (x.n_near, x.best_n, x.best) for x in S.near_words(spark, rows, scratch_dir(spark, "near"), cap=cap).collect()}
    for w, form, _, k, n_near, form_n in spelling_forms(n):
        assert (found[w][0] if w in found else 0) == n_near, w
        if form is not None:
            assert found[w][1:] == (form_n, form)
        elif w in found:
            assert found[w][1] < 2 * k


def test_search_and_vectors():
    assert S.is_near("abcde", "abcd") and S.is_near("abcde", "xabcde") and S.is_near("abcde", "abxde")
    assert not S.is_near("abcde", "abcde") and not S.is_near("abcde", "badce") and not S.is_near("abcde", "abc")
    words = [(w, 1, S.vector(w)) for w in _noisy_words(random.Random(5), 400)]
    trie = S.build_trie(words, 0)
    for w, _, v in words:
        up = {x[0] for leaf in S.search_trie(trie, v, b"") for x in leaf.candidates(w) if S.is_near(w, x[0]) and (x[2], x[0]) > (v, w)}
        assert up == {x for x, _, u in words if S.is_near(w, x) and (u, x) > (v, w)}


def test_spelling_variants(spark, edge_docs, edge_rows, no_docs):
    rows = [(d, t) for d, t, *_ in edge_rows]
    for cap in (3, 4096):
        got = S.spelling_variants(spark, edge_docs, cap=cap)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect())) == spelling(rows)
    assert S.spelling_variants(spark, no_docs).count() == 0
    with pytest.raises(ValueError, match="circles"):
        S.spelling_variants(spark, edge_docs, times=1)


def test_spelling_variants_of_a_table(spark):
    d = load(spark, SF001, "documents")
    assert sorted(map(tuple, S.spelling_variants(spark, d).collect())) == spelling([(r.doc_id, r.text) for r in d.collect()])


def test_roots_follow_long_chains(spark):
    stem, n = "abcdefghijkl", {}
    for i in range(12):
        n[stem[:12 - i] + "m" * 8] = 3 << i
    rows = spark.createDataFrame([(i, f"{w} " * k) for i, (w, k) in enumerate(n.items())], "doc_id long, text string")
    got = sorted(map(tuple, S.spelling_variants(spark, rows, one_in=1 << 40).collect()))
    assert got == spelling_forms(n) and len({r[2] for r in got}) == 1


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_merkle(spark, edge_docs, edge_rows, no_docs, levels):
    rows = [(d, s, lang, n, t) for d, t, lang, s, n in edge_rows]
    got = M.tamper_report(spark, edge_docs, scratch_dir(spark, "merkle"), levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(merkle(rows), key=str)
    assert M.tamper_report(spark, no_docs, scratch_dir(spark, "merkle"), levels=levels).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82])
def test_merkle_trees_of_every_shape(spark, n):
    """Lone last nodes, one source, many sources, and a third of all rows equal."""
    rows = [(i % max(1, n // 2), "a" if i % 3 else f"s{i}", "en", 1, "same\ntext" if i % 3 == 1 else f"text\n{i}") for i in range(n)]
    rows += [(7, "a", "en", 1, "equal\nrow")] * (n // 3)
    d = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(2)
    got = M.tamper_report(spark, d, scratch_dir(spark, "merkle"), levels=2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(merkle(rows), key=str)


def test_merkle_finds_every_change(spark):
    d = load(spark, SF001, "documents")
    from pyspark.sql import functions as F
    found = M.manifest(spark, d, scratch_dir(spark, "merkle"), retext=F.concat("text", F.lit("!")))
    bad = found.where(M.fold(F.col("other"), F.col("path")) == F.col("root")).count()
    good = found.where(M.fold(F.col("leaf"), F.col("path")) == F.col("root")).count()
    assert (bad, good) == (0, d.count())


def test_no_task_numbers_a_whole_source(spark):
    """A source that holds all rows, most of them equal, is numbered in parts."""
    rows = spark.range(0, 4000, 1, 4).selectExpr("'=a' AS tree", "if(id % 3 = 0, id, 5) AS doc_id", "'x' AS leaf")
    base = scratch_dir(spark, "number")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = M._number(spark, rows, ["doc_id", "leaf"], base)
        assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(4000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [r["count"] for r in spark.read.parquet(f"{base}/ranges").groupBy("part").count().collect()]
    assert max(parts) < 4000 / 3


def _close(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("order,block_bytes", [(4, 1 << 25), (2, 2000), (1, 1)])
def test_lm_scores(spark, edge_docs, edge_rows, no_docs, order, block_bytes):
    got = L.score_texts(spark, edge_docs, order=order, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    _close(got.collect(), lm([(d, t) for d, t, *_ in edge_rows], order))
    assert L.score_texts(spark, no_docs).count() == 0


def test_lm_scores_of_a_table_in_many_blocks(spark):
    d = load(spark, SF001, "documents")
    keep = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        _close(L.score_texts(spark, d.repartition(4), block_bytes=1000).collect(), lm([(r.doc_id, r.text) for r in d.collect()], 4))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", keep)


def test_lm_without_texts_to_learn_from(spark):
    d = spark.createDataFrame([(None, "ab"), (None, None)], "doc_id long, text string")
    got = {r.n_tokens: r for r in L.score_texts(spark, d).collect()}
    assert got[2].score == pytest.approx(-3 * np.log10(256)) and got[1].score == pytest.approx(-np.log10(256))
    assert got[2].train_tokens == 0 and not got[2].held_out and got[2].n_known == 0


def test_lm_text_ids_and_order_limits(spark):
    d = spark.createDataFrame([("x1", "one two"), ("x2", "one")], "doc_id string, text string")
    assert sorted(r.doc_id for r in L.score_texts(spark, d).collect()) == ["x1", "x2"]
    with pytest.raises(ValueError):
        L.score_texts(spark, d, order=7)


def test_model_probabilities_add_up(spark):
    """All bytes after a context add up to one, whether it was seen or not."""
    model = Ppm(2)
    for t in ("abracadabra", "abba", "cad"):
        model.learn(t)
    codes = [int.from_bytes(c + bytes([x]), "big") for c in (b"ab", b"zz", b"ra", b"zb") for x in range(256)]
    n = {}
    for t in (b"abracadabra", b"abba", b"cad"):
        for c in L.gram_codes(t, 2).tolist():
            n[c] = n.get(c, 0) + 1
    rows = spark.createDataFrame([(c, n.get(c, 0)) for c in {*codes, *n}], "gram long, n long")
    x = {r.gram: r.x for r in L.gram_scores(spark, rows, 2, scratch_dir(spark, "grams")).collect()}
    for i in range(0, len(codes), 256):
        assert sum(10 ** x[c] for c in codes[i:i + 256]) == pytest.approx(1)
    for c in codes:
        b = c.to_bytes(3, "big")
        assert x[c] == pytest.approx(model.log(b[:2], b[2]))
