"""Operators 5 and 6."""

import random
import zlib

import numpy as np
import pytest
from brute import components, jump, simhash
from pyspark.sql import functions as F

from tidemark.llm import golay, sharding
from tidemark.llm import simhash as S
from tidemark.llm.components import connected_components


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_words_within_two_bits_share_a_golay_key(distance):
    r = random.Random(distance)
    a = np.array([r.randrange(1 << 23) for _ in range(5000)])
    b = np.array([x ^ sum(1 << i for i in r.sample(range(23), distance)) for x in a.tolist()])
    ka, kb = golay.keys(a), golay.keys(b)
    assert ((ka[:, :, None] == kb[:, None, :]) & (ka >= 0)[:, :, None]).any(axis=(1, 2)).all()


def test_every_syndrome_has_an_error_of_at_most_three_bits():
    assert len(set(golay.ERROR.tolist())) == 2048 and np.bitwise_count(golay.ERROR).max() == 3


def _near(r, base, n):
    return [base ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 3))) for _ in range(n)]


@pytest.mark.parametrize("cap", [2, 64])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_keep_all_components(spark, cap, bits):
    r = random.Random(7)
    fps = {0, (1 << 64) - 1} | {x for b in (0, r.getrandbits(64), r.getrandbits(64)) for x in _near(r, b, 90)}
    chain = r.getrandbits(64)
    for i in range(0, 60, 2):
        fps.add(chain)
        chain ^= 3 << i
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    links = S.links(df, max_bits=bits, cap=cap)
    roots = {x.node: x.root for x in connected_components(spark, links, "a", "b").collect()}
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    got = [roots.get(x, x) for x in signed]
    want = components(fps, bits)
    assert len({(g, w) for g, w in zip(got, want)}) == len(set(got)) == len(set(want))


def test_components_of_a_path_and_a_star(spark):
    n = 300
    r = random.Random(3)
    name = list(range(n))
    r.shuffle(name)
    rows = [(name[i], name[i + 1]) for i in range(n - 1)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {x.node: x.root for x in connected_components(spark, spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(n)}, **{1000 + i: 1000 for i in range(200)}}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(spark, none, "a", "b").count() == 0


def test_components_of_an_ordered_path(spark):
    n = 2000
    path = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(spark, path, "a", "b")
    assert got.count() == n and got.where("root <> 0").count() == 0


def _expected(rows):
    fps = [simhash(t) for _, t, *_ in rows]
    group = components(fps)
    least = {}
    for (d, *_), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [(d, f"{f:016x}", least.get(g)) for (d, *_), f, g in zip(rows, fps, group)]


def test_near_duplicates(spark, edge_docs, edge_rows, no_docs):
    got = [tuple(r) for r in S.near_duplicates(spark, edge_docs, cap=3).collect()]
    assert sorted(got, key=str) == sorted(_expected(edge_rows), key=str)
    assert S.near_duplicates(spark, no_docs).count() == 0


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 13} x{i % 7}" for i in range(500))
    monkeypatch.setattr(S, "_STEP", 17)
    assert S.fingerprint(text) == simhash(text)


def test_keep_one_of_each(spark, edge_docs, edge_rows):
    kept = S.keep_one_of_each(spark, edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = {d for d, _, c in _expected(edge_rows) if d is not None and d == c}
    assert sorted(d for d, _ in rows if d is not None) == sorted(want)
    assert S.keep_one_of_each(spark, edge_docs.limit(0)).count() == 0


def test_one_row_stays_of_each_component(spark):
    r = random.Random(5)
    a, b, c, d, e = (" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(5))
    rows = [(3, b), (5, a), (5, b.upper()), (5, c), (5, c), (None, d), (None, d.upper()), (None, a.upper()), (None, e), (9, e.upper())]
    rows += [(7, f"text {i} of one id: " + " ".join(f"v{r.randrange(10**6)}" for _ in range(40))) for i in range(30)]
    first = components([simhash(t) for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(x) for x in S.keep_one_of_each(spark, docs).collect()]
    group = {}
    for (i, t), f in zip(rows, first):
        group.setdefault(f, []).append((i, t))
    mine = {row: f for f, members in group.items() for row in members}
    assert sorted(mine[x] for x in kept) == sorted(group)
    # Of each component stays the smallest id; without any id, one row.
    none_last = lambda i: (i is None, i or 0)
    assert all(none_last(i) == min(none_last(j) for j, _ in group[mine[i, t]]) for i, t in kept)
    assert {(3, b), (5, a), (5, c), (9, e.upper())} <= set(kept) and len([i for i, _ in kept if i == 7]) == 30
    assert len([i for i, _ in kept if i is None]) == 1


def test_shards(spark, edge_docs, edge_rows, no_docs):
    got = sharding.assign_shards(edge_docs, 40, chunks=4).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows), key=str)
    for shard in {r.shard for r in got}:
        mine = sorted(r.slot for r in got if r.shard == shard)
        assert mine == list(range(len(mine)))
    assert all(r.grown_shard in (r.shard, 40) and r.law == "key" for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.assign_shards(no_docs, 40).count() == 0


def test_jump_hash_equals_its_definition_and_moves_few_keys():
    r = random.Random(1)
    keys = np.array([r.getrandbits(64) for _ in range(4000)], dtype=np.uint64)
    a, b = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert a.tolist() == [jump(int(k), 40) for k in keys]
    moved = a != b
    assert set(b[moved]) == {40} and 0.01 < moved.mean() < 0.04
    assert sharding.jump(keys, 1).max() == 0
    assert np.bincount(a, minlength=40).min() > 60


def test_written_shards_hold_every_row_once(spark, workdir, edge_docs):
    sharding.write_shards(edge_docs, workdir, 5, split=2)
    back = spark.read.parquet(workdir)
    assert back.count() == edge_docs.count() and "__shard" in back.columns
    want = sharding.assign_shards(edge_docs, 5).groupBy("shard").count()
    got = back.groupBy(F.col("__shard").alias("shard")).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_repeated_id_is_numbered_by_many_tasks(spark):
    """A third of the rows share an id, a third of those all of the row."""
    rows = [(i, f"text {i}") for i in range(2000)] + [(7, f"other {i}") for i in range(700)] + [(7, "same")] * 300
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.assign_shards(d, 8, chunks=16)
    got = out.collect()
    hot = {r.shard for r in got if r.doc_id == 7}
    assert len(got) == len(rows) and len(hot) == 1
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sum(r.doc_id == 7 and r.text_crc32 == zlib.crc32(b"same") for r in got) == 300


def test_shard_files_of_a_repeated_id(spark, workdir):
    rows = [(i, f"text {i}") for i in range(600)] + [(7, "same")] * 300
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sharding.write_shards(d, workdir, 4, split=8)
    back = spark.read.parquet(workdir)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    assert back.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    files = [r["count"] for r in back.where("doc_id = 7").groupBy(F.input_file_name()).count().collect()]
    assert len(files) >= 4 and max(files) < 150


def test_of_rows_equal_in_id_and_text_the_smallest_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, s, {"k": s}) for s in ("b", "a", None, "c")] + [(2, text, "a", None), (3, text + " and more of it all", "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,string>").repartition(4)
    kept = S.keep_one_of_each(spark, docs).collect()
    assert [(r.doc_id, r.source) for r in kept if r.doc_id == 1] == [(1, None)] and kept[0].m in ({"k": None}, None)
    assert 2 not in {r.doc_id for r in kept}
