"""The commit log of a feed, reads by sequence range, and polled tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import mirror as M
from tidemark.plans.mirror import MirrorSpec, load_state, mirror
from tidemark.sources import feed_log, paths, sinks
from tidemark.sources.files import read_changes
from tidemark.streaming import announce, poll_mirror
from tidemark.tables import load

from conftest import SF001


def spec(top=None, name="feed", **kw):
    def delta(s):
        o = load(s, SF001, "orders")
        return o if top is None else o.where(F.col("o_orderkey") <= top["n"])
    return MirrorSpec(**{**dict(name=name, snapshot=lambda s: load(s, SF001, "lineitem"), snap_key="l_orderkey", delta=delta,
                                delta_key="o_orderkey", mark="o_orderkey", mode="delta"), **kw})


def sequences(spark, root, name="feed"):
    return {r["seq"]: (r["lo"], r["hi"]) for r in read_changes(spark, root, name).groupBy("seq").agg(
        F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi")).collect()}


def runs(spark, root, name="feed"):
    return {d: paths.list_dirs(spark, f"{root}/{name}/{d}") for d in paths.list_dirs(spark, f"{root}/{name}")}


def test_of_two_writers_from_one_state_one_is_refused(spark, workdir, monkeypatch):
    mirror(spark, spec(), workdir, high=100)
    write, other = M.write_run, []

    def overtaken(*a, **kw):
        out = write(*a, **kw)
        monkeypatch.setattr(M, "write_run", write)
        other.append(mirror(spark, spec(), workdir, high=300))
        return out
    monkeypatch.setattr(M, "write_run", overtaken)
    refused = mirror(spark, spec(), workdir, high=200)
    assert "CommitConflict" in refused.error and other[0].error is None and other[0].seq == 2
    assert sequences(spark, workdir) == {1: (0, 100), 2: (101, 300)}
    assert [len(r) for r in runs(spark, workdir).values()] == [1, 1]
    again = mirror(spark, spec(), workdir, high=400)
    assert (again.error, again.seq) == (None, 3) and sequences(spark, workdir)[3] == (301, 400)


def test_create_new_never_replaces(spark, workdir):
    assert paths.create_new(spark, f"{workdir}/a/x.json", "one") and not paths.create_new(spark, f"{workdir}/a/x.json", "two")
    assert paths.read_text(spark, f"{workdir}/a/x.json") == "one" and paths.list_files(spark, f"{workdir}/a") == ["x.json"]


@pytest.mark.parametrize("step", ["during the write", "before the commit", "after the commit"])
def test_a_killed_writer_leaves_the_old_or_the_new_feed(spark, workdir, monkeypatch, step):
    mirror(spark, spec(), workdir, high=100)
    before = read_changes(spark, workdir, "feed")
    rows = before.count()

    class Killed(BaseException):
        pass

    def killed(*a, **kw):
        raise Killed
    target, name = {"during the write": (sinks.Observation, "get"), "before the commit": (M, "save_state"),
                    "after the commit": (feed_log, "drop_other_runs")}[step]
    with monkeypatch.context() as m:
        m.setattr(target, name, property(killed) if name == "get" else killed)
        m.setattr(sinks, "discard_run", lambda *a: None)
        with pytest.raises(Killed):
            mirror(spark, spec(), workdir, high=200)
    done = step == "after the commit"
    assert set(sequences(spark, workdir)) == ({1, 2} if done else {1})
    assert before.count() == rows  # a reader that began before still reads the old feed
    left = runs(spark, workdir).get("seq=0000000002", [])
    r = mirror(spark, spec(), workdir, high=300)
    assert (r.error, r.seq) == (None, 3 if done else 2)
    assert sequences(spark, workdir) == ({1: (0, 100), 2: (101, 200), 3: (201, 300)} if done else {1: (0, 100), 2: (101, 300)})
    assert len(left) == 1 and all(len(x) == 1 for x in runs(spark, workdir).values())


def test_ranges_of_sequences_read_only_their_folders(spark, workdir):
    for high in (100, 200, 300, 400):
        mirror(spark, spec(mode="auto"), workdir, high=high)
    some = read_changes(spark, workdir, "feed", low=1, high=3)
    assert {r.seq for r in some.select("seq").distinct().collect()} == {2, 3}
    files = some.inputFiles()
    assert files and all("seq=0000000002" in f or "seq=0000000003" in f for f in files)
    whole = read_changes(spark, workdir, "feed")
    assert {"__op", "__rowMarker__", "seq"} <= set(whole.columns) and "__op" not in some.columns
    assert whole.count() == spark.read.option("mergeSchema", "true").parquet(f"{workdir}/feed").count()
    none = read_changes(spark, workdir, "feed", low=9)
    assert none.count() == 0 and set(none.columns) == set(whole.columns)


def test_a_long_feed_is_sealed_in_segments(spark, workdir, monkeypatch):
    monkeypatch.setattr(feed_log, "SEGMENT", 3)
    log = None
    for i in range(1, 9):
        seq = i if i < 5 else i + 10  # a stream skips the numbers of empty batches
        df = spark.range(i).withColumn("v", F.lit(i))
        n, run = sinks.write_run(df, workdir, "t", seq)
        log = feed_log.commit(spark, workdir, "t", log, {"last_sequence": seq}, seq=seq, run=run, rows=n, schema=df.schema)
    assert log.sealed == [3, 16] and len(log.entries) == 2 and len(log.schemas) == 1
    for low, high in ((None, None), (0, 3), (3, None), (2, 15), (16, 17), (18, 99)):
        want = {s for s in (1, 2, 3, 4, 15, 16, 17, 18) if (low is None or s > low) and (high is None or s <= high)}
        assert {r.seq for r in read_changes(spark, workdir, "t", low, high).select("seq").distinct().collect()} == want
    with pytest.raises(feed_log.CommitConflict):
        feed_log.commit(spark, workdir, "t", feed_log.Log(log.number - 1, log.doc), {"last_sequence": 99})


def test_schemas_of_a_feed_are_merged(spark):
    a, b, c = (spark.createDataFrame([], s).schema.json() for s in ("k int, v string", "w double, k long", "k string"))
    assert feed_log.merged_schema([a, b]).simpleString() == "struct<k:bigint,v:string,w:double>"
    with pytest.raises(ValueError, match="'k'"):
        feed_log.merged_schema([a, c])


def test_a_polled_table_is_read_from_the_saved_mark(spark, workdir):
    top = {"n": 300}
    assert mirror(spark, spec(top), workdir).watermark == 300
    assert announce(spark, spec(top), workdir) is None and poll_mirror(spark, spec(top), workdir) is None
    top["n"] = 700
    poll_mirror(spark, spec(top), workdir, high=500)
    poll_mirror(spark, spec(top), workdir, polls=2)
    assert sequences(spark, workdir) == {1: (0, 300), 2: (301, 500), 3: (501, 700)}
    assert load_state(spark, workdir, "feed")["last_watermark"] == 700
    assert "written by the stream" in mirror(spark, spec(top), workdir).error


def test_a_replayed_poll_covers_the_same_requests(spark, workdir):
    """Killed between the batch's offset and its commit; meanwhile the table grows."""
    top, fail = {"n": 300}, {"on": True}

    def snapshot(s):
        if fail["on"]:
            raise RuntimeError("lost")
        return load(s, SF001, "lineitem")
    feed = spec(top, snapshot=snapshot)
    with pytest.raises(Exception, match="lost"):
        poll_mirror(spark, feed, workdir)
    top["n"], fail["on"] = 600, False
    poll_mirror(spark, feed, workdir)
    assert sequences(spark, workdir) == {1: (0, 300), 2: (301, 600)}


def test_two_polls_announce_a_range_once(spark, workdir, monkeypatch):
    from tidemark.streaming import poll
    feed = spec({"n": 200})
    create = paths.create_new

    def overtaken(s, path, text):
        monkeypatch.setattr(poll.paths, "create_new", create)
        assert announce(spark, feed, workdir) == (None, 200)
        return create(s, path, text)
    monkeypatch.setattr(poll.paths, "create_new", overtaken)
    with pytest.raises(RuntimeError, match="announced range 0 first"):
        announce(spark, feed, workdir)


def test_sql_delta_folder_reads_marks_of_every_kind(spark, workdir):
    """Zero, negative and text marks of a folder with a delta statement only."""
    import json
    snap = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    snap.createOrReplaceTempView("snap_t")
    for name, rows, kind in (("n", [(-2, 1), (0, 2), (3, 3)], "long"), ("t", [("", 1), ("0", 2), ("b", 3)], "string"),
                             ("d", [(-2.5, 1), (0.0, 2), (3.5, 3)], "double")):
        spark.createDataFrame(rows, f"m {kind}, k long").createOrReplaceTempView(f"requests_{name}")
        base = f"{workdir}/q/{name}"
        paths.write_text(spark, f"{base}/delta.sql", f"SELECT 4 AS __rowMarker__, s.* FROM requests_{name} r JOIN snap_t s USING (k) "
                                                     "WHERE r.m > {WATERMARK} AND r.m <= :high")
        paths.write_text(spark, f"{base}/mirror.json", json.dumps({"watermark_table": f"requests_{name}", "watermark_column": "m"}))
    got = {r.name: (r.rows, r.error) for r in M.mirror_all(spark, M.specs_in_folder(spark, f"{workdir}/q"), f"{workdir}/out")}
    # An empty text is no mark above the lowest one.
    assert got == {"n": (3, None), "t": (2, None), "d": (3, None)}
