import time
import json
import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import change_rows
from tidemark.operators.nested import build_catalog, catalog_entries, flatten_catalog
from tidemark.plans.catalog import profile
from tidemark.plans.export import export, export_all, previous_marks, read_run_log
from tidemark.operators.filters import mark_range
from tidemark.plans.mirror import MirrorSpec, load_state, mirror
from tidemark.sources import paths
from tidemark.sources.catalog_doc import read_catalog, write_catalog
from tidemark.sources.files import read_changes
from tidemark.streaming import delta_stream, stream_mirror
from tidemark.tables import load

from conftest import SF001


def spec(sf=SF001, **kw):
    return MirrorSpec(name="feed", snapshot=lambda s: load(s, sf, "lineitem"), snap_key="l_orderkey",
                      delta=lambda s: load(s, sf, "orders"), delta_key="o_orderkey", mark="o_orderkey",
                      full_order=("l_orderkey", "l_linenumber"), **kw)


def rows_of(df):
    return df.drop("seq")


def test_first_run_is_full_and_seeds_mark(spark, workdir):
    r = mirror(spark, spec(), workdir, high=100)
    assert (r.mode, r.seq, r.error) == ("full", 1, None)
    assert r.rows == load(spark, SF001, "lineitem").count()
    st = load_state(spark, workdir, "feed")
    assert st["last_sequence"] == 1 and st["last_watermark"] == 100


def test_delta_runs_add_up_and_empty_run_keeps_sequence(spark, workdir):
    s = spec(mode="delta")
    a = mirror(spark, s, workdir, high=300)
    b = mirror(spark, s, workdir, high=600)
    c = mirror(spark, s, workdir)
    again = mirror(spark, s, workdir)
    assert [x.seq for x in (a, b, c, again)] == [1, 2, 3, 3]
    assert again.rows == 0
    assert paths.list_dirs(spark, f"{workdir}/feed") == [f"seq={i:010d}" for i in (1, 2, 3)]
    one_go = change_rows(load(spark, SF001, "orders"), load(spark, SF001, "lineitem"), delta_key="o_orderkey",
                         snap_key="l_orderkey", mark="o_orderkey")
    got = rows_of(read_changes(spark, workdir, "feed"))
    assert got.count() == one_go.count() and got.exceptAll(one_go.select(*got.columns)).count() == 0


def test_failed_run_repeats_its_sequence(spark, workdir):
    good = spec(mode="delta")
    mirror(spark, good, workdir, high=300)

    def broken(s):
        return load(s, SF001, "lineitem").withColumn("l_tax", F.raise_error(F.lit("boom")))

    bad = MirrorSpec(**{**good.__dict__, "snapshot": broken})
    r = mirror(spark, bad, workdir, high=600)
    assert r.error is not None
    assert load_state(spark, workdir, "feed")["last_sequence"] == 1
    ok = mirror(spark, good, workdir, high=600)
    assert ok.seq == 2 and ok.error is None


def test_delta_file_is_ordered_by_mark_then_key(spark, workdir):
    mirror(spark, spec(mode="delta"), workdir)
    d = spark.read.parquet(f"{workdir}/feed/seq=0000000001").select("l_orderkey").collect()
    keys = [r.l_orderkey for r in d]
    assert keys == sorted(keys)


def test_stream_equals_batch(spark, workdir):
    src = f"{workdir}/src"
    for low, high in ((None, 400), (400, 900), (900, None)):
        load(spark, SF001, "orders").where(mark_range("o_orderkey", low, high)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # files are taken in order of their times
    q = stream_mirror(spark, delta_stream(spark, src, max_files_per_trigger=1), lambda s: load(s, SF001, "lineitem"),
                      name="s", root=workdir, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
    assert q.lastProgress is not None
    streamed = read_changes(spark, workdir, "s")
    assert sorted(r.seq for r in streamed.select("seq").distinct().collect()) == [1, 2, 3]
    batch = change_rows(load(spark, SF001, "orders"), load(spark, SF001, "lineitem"), delta_key="o_orderkey",
                        snap_key="l_orderkey", mark="o_orderkey")
    s = streamed.drop("seq")
    assert s.count() == batch.count() and s.exceptAll(batch.select(*s.columns)).count() == 0
    # A second start finds nothing new and adds no sequence.
    stream_mirror(spark, delta_stream(spark, src, max_files_per_trigger=1), lambda s: load(s, SF001, "lineitem"),
                  name="s", root=workdir, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
    assert paths.list_dirs(spark, f"{workdir}/s") == [f"seq={i:010d}" for i in (1, 2, 3)]
    assert load_state(spark, workdir, "s")["last_sequence"] == 3


SQL = ("SELECT event_id AS PK1, ts AS WM1, event_id AS WM2, value FROM events "
       "WHERE ts > :wm1 OR (ts = :wm1 AND event_id > :wm2)")


def test_export_binds_previous_marks(spark, workdir):
    ev = load(spark, SF001, "events")
    mid = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    ev.where(F.col("event_id") <= mid).createOrReplaceTempView("events")
    target = f"{workdir}/events"
    import datetime as dt
    first = export(spark, "events", SQL, target, initial=(dt.datetime(1900, 1, 1), -1))
    assert first.error is None and first.rows == ev.where(F.col("event_id") <= mid).count()
    ev.createOrReplaceTempView("events")
    marks = previous_marks(spark, target)
    second = export(spark, "events", SQL, target)
    assert second.marks == marks and second.rows == ev.where(F.col("event_id") > mid).count()
    # The snapshot now holds the new rows only.
    assert spark.read.parquet(target).agg(F.min("PK1")).first()[0] > mid


def test_export_folder_logs_failures_and_continues(spark, workdir):
    load(spark, SF001, "lineitem").createOrReplaceTempView("lineitem")
    load(spark, SF001, "customer").createOrReplaceTempView("customer")
    res = export_all(spark, {"b_dup": "SELECT l_orderkey AS PK1 FROM lineitem",
                             "a_ok": "SELECT c_custkey AS PK1 FROM customer",
                             "c_bad": "SELECT nope FROM customer"}, workdir)
    assert [r.name for r in res] == ["a_ok", "b_dup", "c_bad"]
    assert res[0].error is None and "repeats" in res[1].error and res[2].error
    assert not paths.exists(spark, f"{workdir}/b_dup")
    log = {r.name: r for r in read_run_log(spark, f"{workdir}/_runs").collect()}
    assert log["a_ok"].rows == 1500 * 0 + load(spark, SF001, "customer").count() and log["c_bad"].error


def _objects(spark):
    o = load(spark, SF001, "orders")
    return {("s", "orders"): ("table", o), ("s", "region"): ("table", load(spark, SF001, "region")),
            ("s", "empty"): ("table", o.where("false")), ("s", "v"): ("view", o.select("o_orderkey"), True),
            ("s", "hidden"): ("view", o, False)}


def test_catalog_round_trip(spark, workdir):
    entries = profile(spark, _objects(spark), map_types=True)
    assert {(r.kind, r.object) for r in entries.collect()} == {("table", "orders"), ("table", "region"),
                                                                ("view", "v")}
    doc = build_catalog(entries, "2026-01-01T00:00:00")
    write_catalog(doc, f"{workdir}/cat")
    back = flatten_catalog(read_catalog(spark, f"{workdir}/cat", nested=True))
    direct = flatten_catalog(doc)
    assert back.count() == direct.count() and back.exceptAll(direct).count() == 0
    write_catalog(entries, f"{workdir}/lines", "2026-01-01T00:00:00")  # one line per object
    lines = read_catalog(spark, f"{workdir}/lines")
    assert {r.generated_at for r in lines.collect()} == {"2026-01-01T00:00:00"}
    per_object = flatten_catalog(lines)
    assert per_object.count() == direct.count() and per_object.exceptAll(direct).count() == 0
    cols = [r.COLUMN_NAME for r in back.where("object = 'orders'").orderBy("ORDINAL_POSITION").collect()]
    assert cols == load(spark, SF001, "orders").columns
    types = entries.where("object = 'orders'").first().entry.pyarrow_cols
    assert types[0].type == "int64"


def test_catalog_without_counts_or_views(spark):
    entries = profile(spark, _objects(spark), count_tables=False, include_views=False)
    assert {r.object for r in entries.collect()} == {"orders", "region", "empty"}
    assert all(r.entry.row_count is None for r in entries.collect())


def test_catalog_count_failure_is_unknown(spark, workdir):
    objs = _objects(spark)
    spark.range(3).write.parquet(f"{workdir}/gone")
    bad = spark.read.parquet(f"{workdir}/gone")
    paths.delete(spark, f"{workdir}/gone")  # files vanish after the frame is defined
    objs[("s", "broken")] = ("table", bad)
    entries = profile(spark, objs)
    names = {r.object for r in entries.collect()}
    assert "broken" not in names and {"orders", "region", "v"} <= names


def test_the_newest_readable_state_counts(spark, workdir):
    from tidemark.plans.mirror import save_state, state_dir
    from tidemark.sources.feed_log import KEEP_STATES
    assert load_state(spark, workdir, "feed") == {"last_sequence": 0, "last_watermark": None}
    for i in range(KEEP_STATES + 2):
        save_state(spark, workdir, "feed", seq=i, watermark=f"00{i}", watermark_type="string", watermark_column="m", mode="delta")
    names = paths.list_files(spark, state_dir(workdir, "feed"))
    assert len([n for n in names if n.endswith(".json")]) == KEEP_STATES
    paths.write_text(spark, f"{state_dir(workdir, 'feed')}/000000000099.json", "{not js")
    st = load_state(spark, workdir, "feed")
    assert (st["last_sequence"], st["last_watermark"]) == (KEEP_STATES + 1, f"00{KEEP_STATES + 1}")


def test_a_feed_without_state_is_never_started_over(spark, workdir):
    from tidemark.plans.mirror import state_dir
    mirror(spark, spec(), workdir, high=100)
    paths.delete(spark, state_dir(workdir, "feed"))
    before = read_changes(spark, workdir, "feed").count()
    assert "no readable state" in mirror(spark, spec(), workdir).error
    assert read_changes(spark, workdir, "feed").count() == before


def test_text_marks_keep_their_zeros(spark, workdir):
    rows = [(f"{i:010d}", i) for i in range(1, 8)]
    snap = spark.createDataFrame([(i, f"v{i}") for i in range(1, 8)], "k long, v string")
    state = {"n": 3}
    s = MirrorSpec(name="t", snapshot=lambda _: snap, snap_key="k", delta_key="k", mark="m", mode="delta",
                   delta=lambda sp: sp.createDataFrame(rows[:state["n"]], "m string, k long"))
    assert mirror(spark, s, workdir).rows == 3
    state["n"] = 7
    r = mirror(spark, s, workdir)
    assert (r.rows, r.watermark, r.error) == (4, "0000000007", None)


def test_marks_at_or_below_zero_are_read(spark, workdir):
    delta = spark.createDataFrame([(-2, 1), (0, 2), (3, 3)], "m long, k long")
    s = MirrorSpec(name="z", snapshot=lambda sp: sp.createDataFrame([(1,), (2,), (3,)], "k long"), snap_key="k", delta_key="k",
                   mark="m", mode="delta", delta=lambda _: delta)
    assert mirror(spark, s, workdir).rows == 3


def test_folder_modes(spark, workdir):
    """Full only repeats; delta only and full + delta go on by delta; a folder
    without SQL is an error of its own."""
    from tidemark.plans.mirror import mirror_all, specs_in_folder
    load(spark, SF001, "orders").createOrReplaceTempView("orders")
    full, delta = "SELECT o_orderkey FROM orders", "SELECT o_orderkey FROM orders WHERE o_orderkey > {WATERMARK} AND false"
    settings = json.dumps({"watermark_table": "orders", "watermark_column": "o_orderkey"})
    q = f"{workdir}/q"
    for name, files in {"a": {"full.sql": full}, "b": {"delta.sql": delta, "mirror.json": settings},
                        "c": {"full.sql": full, "delta.sql": delta}, "d": {"full.sql": full, "mirror.json": settings},
                        "e": {"readme.txt": "-"}}.items():
        for f, text in files.items():
            paths.write_text(spark, f"{q}/{name}/{f}", text)
    specs = specs_in_folder(spark, q)
    first, second = ({r.name: r for r in mirror_all(spark, specs, f"{workdir}/out")} for _ in range(2))
    assert [first[n].mode for n in "abcd"] == ["full", "delta", "full", "full"]
    assert [second[n].mode for n in "abcd"] == ["full", "delta", "delta", "full"]
    assert all(r[n].error is None for r in (first, second) for n in "abcd")
    assert "no SQL statement" in first["e"].error


def test_stream_goes_on_after_a_batch_feed_and_keeps_its_mark(spark, workdir):
    r = mirror(spark, spec(), workdir, high=100)
    before = spark.read.parquet(f"{workdir}/feed/seq=0000000001").count()
    o, src = load(spark, SF001, "orders"), f"{workdir}/src"

    def step(rows):
        rows.write.mode("append").parquet(src)
        stream_mirror(spark, delta_stream(spark, src), lambda s: load(s, SF001, "lineitem"), name="feed", root=workdir,
                      delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
        return load_state(spark, workdir, "feed")
    one = step(o.where("o_orderkey > 100 and o_orderkey <= 500"))
    assert (r.seq, one["last_sequence"], one["last_watermark"]) == (1, 2, 500)
    late = step(o.where("o_orderkey between 90 and 300"))
    assert (late["last_sequence"], late["last_watermark"]) == (2, 500)
    assert spark.read.parquet(f"{workdir}/feed/seq=0000000001").count() == before
    assert "written by the stream" in mirror(spark, spec(), workdir).error
    with pytest.raises(ValueError, match="written by the stream"):
        stream_mirror(spark, delta_stream(spark, src), lambda s: load(s, SF001, "lineitem"), name="feed", root=workdir,
                      delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey", checkpoint=f"{workdir}/other")


FULL_SQL = """SELECT 0 AS __watermark, 'u' AS __op, 0 AS __deleted, m.*
FROM lineitem AS m ORDER BY m.l_orderkey, m.l_linenumber"""

DELTA_SQL = """SELECT CASE WHEN m.l_orderkey IS NULL THEN 2 ELSE 4 END AS __rowMarker__, d.o_orderkey AS l_orderkey,
  m.l_partkey, m.l_suppkey, m.l_linenumber, m.l_quantity, m.l_extendedprice, m.l_discount, m.l_tax,
  m.l_returnflag, m.l_linestatus, m.l_shipdate
FROM orders AS d LEFT JOIN lineitem AS m ON m.l_orderkey = d.o_orderkey
WHERE d.o_orderkey > {WATERMARK} AND d.o_orderkey <= :high
ORDER BY d.o_orderkey ASC, d.o_orderkey ASC"""


def test_sql_folder_mirror_equals_dataframe_mirror(spark, workdir):
    import json as _json
    from tidemark.plans.mirror import specs_in_folder
    from tidemark.sources.sql import statements_in
    for t in ("orders", "lineitem"):
        load(spark, SF001, t).createOrReplaceTempView(t)
    folder = f"{workdir}/queries"
    paths.write_text(spark, f"{folder}/feed/full.sql", FULL_SQL)
    paths.write_text(spark, f"{folder}/feed/delta.sql", DELTA_SQL)
    paths.write_text(spark, f"{folder}/feed/mirror.json",
                     _json.dumps({"watermark_table": "orders", "watermark_column": "o_orderkey"}))
    paths.write_text(spark, f"{folder}/a.sql", "SELECT o_orderkey AS PK1 FROM orders WHERE o_orderkey > {WM1}")
    paths.write_text(spark, f"{folder}/_skip.sql", "SELECT 1")
    assert statements_in(spark, folder) == {"a": "SELECT o_orderkey AS PK1 FROM orders WHERE o_orderkey > :wm1"}
    (sql_feed,) = specs_in_folder(spark, folder)
    for high in (300, 600, None):
        r = mirror(spark, sql_feed, f"{workdir}/sql", high=high)
        assert r.error is None, r.error
    for high in (300, 600, None):
        assert mirror(spark, spec(), f"{workdir}/df", high=high).error is None
    a = read_changes(spark, f"{workdir}/sql", "feed")
    b = read_changes(spark, f"{workdir}/df", "feed").select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_export_folder_writes_metadata_and_mirror_log(spark, workdir):
    import json as _json
    from tidemark.plans.export import export_folder
    from tidemark.plans.mirror import mirror_all
    load(spark, SF001, "customer").createOrReplaceTempView("customer")
    paths.write_text(spark, f"{workdir}/q/customers.sql", "SELECT c_custkey AS PK1 FROM customer")
    (res,) = export_folder(spark, f"{workdir}/q", f"{workdir}/out")
    meta = _json.loads(paths.read_text(spark, f"{workdir}/out/customers.metadata.json"))
    assert meta["name"] == "customers" and meta["rows"] == res.rows > 0 and meta["error"] is None
    results = mirror_all(spark, [spec(mode="delta")], f"{workdir}/m")
    log = read_run_log(spark, f"{workdir}/m/_runs").collect()
    assert [(r.name, r.rows) for r in log] == [("feed", results[0].rows)]


def test_folder_without_full_or_delta_reruns_its_query(spark, workdir):
    from tidemark.plans.mirror import specs_in_folder
    load(spark, SF001, "region").createOrReplaceTempView("region")
    folder = f"{workdir}/queries"
    paths.write_text(spark, f"{folder}/regions/b.sql", "SELECT 'u' AS __op, r_regionkey FROM region")
    paths.write_text(spark, f"{folder}/regions/query.sql", "SELECT 0 AS __watermark, r_regionkey FROM region")
    (s,) = specs_in_folder(spark, folder)
    first = mirror(spark, s, f"{workdir}/out")
    second = mirror(spark, s, f"{workdir}/out")
    assert (first.mode, first.seq, second.seq) == ("full", 1, 2)
    assert read_changes(spark, f"{workdir}/out", "regions").columns[0] == "__watermark"


def test_conform_from_catalog(spark, workdir):
    from tidemark.plans.catalog import conform_from_catalog
    meta = spark.createDataFrame(
        [("s", "t", "a", "NVARCHAR", 2, None, None, 2), ("s", "t", "b", "DECIMAL", None, 6, 2, 1)],
        "schema string, object string, COLUMN_NAME string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH long, "
        "NUMERIC_PRECISION long, NUMERIC_SCALE long, ORDINAL_POSITION long").withColumn("IS_NULLABLE", F.lit("YES"))
    objs = spark.createDataFrame([("s", "t", "table")], "schema string, object string, kind string")
    counts = spark.createDataFrame([("s", "t", 1)], "schema string, object string, row_count long")
    write_catalog(build_catalog(catalog_entries(objs, meta, counts), "2026-01-01T00:00:00"), f"{workdir}/cat")
    cat = read_catalog(spark, f"{workdir}/cat", nested=True)
    out = conform_from_catalog(spark.createDataFrame([("xyz", 1.234)], "a string, b double"), cat, "s", "t",
                               on_long_text="truncate")
    assert out.columns == ["b", "a"]
    r = out.first()
    assert (str(r.b), r.a) == ("1.23", "xy")
    with pytest.raises(ValueError):
        conform_from_catalog(spark.range(1), cat, "s", "missing")


def test_catalog_from_session(spark):
    from tidemark.plans.catalog import catalog_objects_from_session
    load(spark, SF001, "region").createOrReplaceTempView("tm_region_view")
    objs = catalog_objects_from_session(spark, include_temporary=True)
    assert objs[("default", "tm_region_view")][0] == "view"
    entries = profile(spark, objs)
    row = entries.where("object = 'tm_region_view'").first()
    assert [c.COLUMN_NAME for c in row.entry.columns] == ["r_regionkey", "r_name"]
    assert catalog_objects_from_session(spark, ["default"]) == {}  # temporary views left out by default


def test_wall_clock_marks_ignore_session_time_zone(spark, workdir):
    import datetime as dt
    from tidemark.operators.filters import since
    ev = load(spark, SF001, "events")
    ts = sorted(r.ts for r in ev.select("ts").collect())
    mid = ts[len(ts) // 2]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert since(ev, "ts", mid).count() == sum(1 for t in ts if t > mid)
        assert since(ev, "ts").count() == len(ts)  # no saved mark: no lower bound on a timestamp
        ev.createOrReplaceTempView("events")
        target = f"{workdir}/ev"
        first = export(spark, "ev", SQL, target, initial=("1900-01-01 00:00:00", -1))
        second = export(spark, "ev", SQL, target)
        assert first.error is None and first.rows == len(ts)
        assert second.error is None and second.rows == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_profile_scope_applies_before_counting(spark):
    objs = _objects(spark)
    objs[("SYS_X", "t")] = ("table", load(spark, SF001, "region"))
    objs[("other", "t")] = ("table", load(spark, SF001, "region"))
    all_user = {r.schema for r in profile(spark, objs, all_schemas=True).collect()}
    assert all_user == {"s", "other"}
    only = {r.schema for r in profile(spark, objs, schemas=["other"]).collect()}
    assert only == {"other"}
    with pytest.raises(ValueError):
        profile(spark, objs, default_schema="none")


def test_missing_tuple_position_binds_null(spark, workdir):
    from tidemark.plans.export import mark_args
    args = mark_args((5,), None, "SELECT * FROM t WHERE a > :wm1 OR :wm2 IS NULL OR b > :wm3")
    assert args == {"wm1": 5, "wm2": None, "wm3": None}
    load(spark, SF001, "orders").createOrReplaceTempView("orders")
    target = f"{workdir}/o"
    sql = "SELECT o_orderkey AS WM1, o_orderkey AS PK1 FROM orders WHERE o_orderkey > :wm1 OR :wm2 IS NOT NULL"
    assert export(spark, "o", sql, target, initial=(-1, None)).error is None
    again = export(spark, "o", sql, target)
    assert again.error is None and again.rows == 0


def test_continuous_stream_picks_up_new_files(spark, workdir):
    src = f"{workdir}/src"
    o = load(spark, SF001, "orders")
    o.where("o_orderkey < 500").coalesce(1).write.parquet(src)
    q = stream_mirror(spark, delta_stream(spark, src), lambda s: load(s, SF001, "lineitem"), name="c", root=workdir,
                      delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey",
                      available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        o.where("o_orderkey >= 500").coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    seqs = sorted(r.seq for r in read_changes(spark, workdir, "c").select("seq").distinct().collect())
    assert seqs == [1, 2]
    streamed = read_changes(spark, workdir, "c").drop("seq")
    batch = change_rows(o, load(spark, SF001, "lineitem"), delta_key="o_orderkey", snap_key="l_orderkey",
                        mark="o_orderkey")
    assert streamed.count() == batch.count() and streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
