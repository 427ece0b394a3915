import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import cast_type, file_type, spark_type
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.fixed import SYSTEM_SCHEMA_NAMES, SYSTEM_SCHEMA_PREFIX
from tidemark.operators.filters import in_schemas, mark_range, non_empty, non_system_schemas, since, with_any_tag
from tidemark.operators.ordering import placed
from tidemark.operators.project import conform, envelope, normalise_columns
from tidemark.tables import load

from conftest import SF001

META = "DATA_TYPE string, NUMERIC_PRECISION long, NUMERIC_SCALE long, CHARACTER_MAXIMUM_LENGTH long"


@pytest.mark.parametrize("dtype,p,s,n,cast,file", [
    ("DECIMAL", 10, 2, None, "DECIMAL(10,2)", "decimal128(10,2)"),
    ("decimal", 0, None, None, "DECIMAL(38,0)", "decimal128(38,0)"),
    ("NUMERIC", None, 3, None, "DECIMAL(38,3)", "decimal128(38,3)"),
    ("BIGINT", None, None, None, "BIGINT", "int64"),
    ("SMALLINT", None, None, None, "SMALLINT", "int64"),
    ("TINYINT", None, None, None, "TINYINT", "int64"),
    ("INTEGER", None, None, None, "INTEGER", "int64"),
    ("ST_POINT", None, None, None, "INTEGER", "int64"),
    ("REAL", None, None, None, "DOUBLE", "float64"),
    ("SECONDDATE", None, None, None, "TIMESTAMP", "timestamp"),
    ("DATE", None, None, None, "DATE", "timestamp"),
    ("VARBINARY", None, None, None, "BLOB", "binary"),
    ("NVARCHAR", None, None, 12, "NVARCHAR(12)", "string"),
    ("NVARCHAR", None, None, None, "NVARCHAR(5000)", "large_string"),
    ("VARCHAR", None, None, 2000, "VARCHAR(2000)", "large_string"),
    ("CHAR", None, None, 0, "CHAR(1)", "large_string"),
    ("ALPHANUM", None, None, 4, "VARCHAR(8000)", "string"),
    (None, None, None, None, "VARCHAR(8000)", "large_string"),
])
def test_type_rules(spark, dtype, p, s, n, cast, file):
    df = spark.createDataFrame([(dtype, p, s, n)], META)
    args = [df[c] for c in df.columns]
    r = df.select(cast_type(*args).alias("c"), file_type(*args).alias("f")).first()
    assert (r.c, r.f) == (cast, file)


def test_spark_type_mapping():
    assert spark_type("DECIMAL(12,2)")[0].simpleString() == "decimal(12,2)"
    assert spark_type("NVARCHAR(3)") == (spark_type("VARCHAR(9)")[0], 3)
    assert spark_type("TINYINT")[0].simpleString() == "smallint"
    with pytest.raises(ValueError):
        spark_type("GEOMETRY")


def test_conform_casts_cuts_and_orders(spark):
    df = spark.createDataFrame([("12", "abcdef", 1.5)], "a string, b string, c double")
    spec = [{"COLUMN_NAME": "c", "DATA_TYPE": "DECIMAL", "NUMERIC_PRECISION": 5, "NUMERIC_SCALE": 1,
             "ORDINAL_POSITION": 2},
            {"COLUMN_NAME": "b", "DATA_TYPE": "NVARCHAR", "CHARACTER_MAXIMUM_LENGTH": 3, "ORDINAL_POSITION": 3},
            {"COLUMN_NAME": "a", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 1},
            {"COLUMN_NAME": None, "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 4}]
    out = conform(df, spec, on_long_text="truncate")
    assert out.columns == ["a", "c", "b"]
    r = out.first()
    assert (r.a, float(r.c), r.b) == (12, 1.5, "abc")
    assert conform(df, spec, on_long_text="keep").first().b == "abcdef"
    with pytest.raises(Exception):
        conform(df, spec).collect()
    free = [{**d, "CHARACTER_MAXIMUM_LENGTH": None} for d in spec]
    assert conform(df, free).first().b == "abcdef"


def test_conform_keeps_undeclared_lengths_and_nested_columns(spark):
    df = spark.createDataFrame([("x" * 9000, "yes", [1.5], True)], "a string, b string, c array<float>, d boolean")
    spec = [{"COLUMN_NAME": n, "DATA_TYPE": t, "ORDINAL_POSITION": i} for i, (n, t) in enumerate(
        (("a", "STRING"), ("b", "CHAR"), ("c", "ARRAY<FLOAT>"), ("d", "BOOLEAN")))]
    assert tuple(conform(df, spec).first()) == ("x" * 9000, "yes", [1.5], True)


def test_conform_bad_values(spark):
    df = spark.createDataFrame([("x",)], "a string")
    spec = [{"COLUMN_NAME": "a", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 1}]
    with pytest.raises(Exception):
        conform(df, spec).collect()
    assert conform(df, spec, on_error="null").first().a is None


def test_conform_refuses_without_metadata(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1), [])


def test_envelope_and_normalise(spark):
    e = envelope(spark.createDataFrame([(1,)], "k long"), version=7)
    assert e.columns == ["__watermark", "__op", "__deleted", "k"] and tuple(e.first()) == (7, "u", 0, 1)
    raw = spark.createDataFrame(
        [(None, "", "colB", None, "int", 10, None, None, True, 2),
         ("colA", None, None, "NVARCHAR", None, 5, None, "NO", True, 1)],
        "COLUMN_NAME string, COLUMN string, FIELD_NAME string, SQL_TYPE_NAME string, DATA_TYPE_NAME string, "
        "LENGTH long, PRECISION long, IS_NULLABLE string, NULLABLE boolean, POSITION long")
    rows = normalise_columns(raw).orderBy("ORDINAL_POSITION").collect()
    assert [(r.COLUMN_NAME, r.DATA_TYPE, r.IS_NULLABLE) for r in rows] == [("colA", "NVARCHAR", "NO"),
                                                                         ("colB", "int", "YES")]


def test_filters(spark):
    df = spark.createDataFrame([(0,), (5,), (9,)], "m long")
    assert [r.m for r in since(df, "m", None).collect()] == [0, 5, 9]
    assert [r.m for r in df.where(mark_range("m", floor=0)).collect()] == [5, 9]
    assert [r.m for r in since(df, "m", 5).collect()] == [9]
    assert [r.m for r in since(df, "m", 0, 5).collect()] == [5]
    schemas = spark.createDataFrame([(f"{SYSTEM_SCHEMA_PREFIX.lower()}_x",), *((n.lower(),) for n in SYSTEM_SCHEMA_NAMES), ("sales",), ("A",)], "SCHEMA_NAME string")
    assert [r[0] for r in non_system_schemas(schemas).collect()] == ["A", "sales"]
    assert in_schemas(schemas, schemas=["sales"]).count() == 1
    assert in_schemas(schemas, default_schema="A").count() == 1
    counts = spark.createDataFrame([("a", 0), ("b", None), ("c", 3)], "t string, row_count long")
    assert [r.t for r in non_empty(counts).collect()] == ["c"]
    assert non_empty(counts, counted=False).count() == 3


def test_tag_filter(spark):
    r = spark.createDataFrame(
        [(1, [("t1", "gold")]), (2, [("t2", "silver")]), (3, None), (4, [])],
        "id long, tags array<struct<id:string,displayName:string>>")
    assert [x.id for x in with_any_tag(r, ["gold"]).collect()] == [1]
    assert [x.id for x in with_any_tag(r, ["t2"]).collect()] == [2]
    assert with_any_tag(r, []).count() == 4


def _cr(spark, strategy, **kw):
    delta = spark.createDataFrame([(1, 10), (2, 11), (3, 10), (4, None), (5, 12)], "mark long, key long")
    snap = spark.createDataFrame([(10, 1, "a"), (10, 2, "b"), (11, 1, "c")], "key long, pos int, v string")
    return J.change_rows(delta, snap, delta_key="key", snap_key="key", mark="mark", strategy=strategy, **kw)


def _key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


def test_change_rows_semantics(spark):
    rows = sorted((tuple(r) for r in _cr(spark, "split", keep_mark=True).collect()), key=_key)
    assert rows == sorted([(4, 10, 1, "a", 1), (4, 10, 2, "b", 1), (4, 11, 1, "c", 2), (4, 10, 1, "a", 3),
                           (4, 10, 2, "b", 3), (2, None, None, None, 4), (2, 12, None, None, 5)], key=_key)
    outer = sorted((tuple(r) for r in _cr(spark, "outer", keep_mark=True).collect()), key=_key)
    assert outer == rows
    latest = sorted((tuple(r) for r in _cr(spark, "split", keep_mark=True, latest_only=True, low=1).collect()),
                    key=_key)
    assert [r for r in latest if r[1] == 10] == [(4, 10, 1, "a", 3), (4, 10, 2, "b", 3)]


def test_change_rows_hot_key_matches_outer_join(spark):
    o = load(spark, SF001, "orders")
    li = load(spark, SF001, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")))
    a = J.change_rows(o, hot, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
    b = J.change_rows(o, hot, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey", strategy="outer")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_with_children_and_errors(spark):
    nodes = spark.createDataFrame(
        [(0, "r1", "Root", None), (1, "c1", "Child", "r1"), (2, "g1", "Grand", "c1"), (3, "r2", "Root", None)],
        "pos long, id string, displayName string, parentId string")
    out = J.with_children(nodes, ["Root", "c1"]).orderBy("root_pos", "level", "pos").collect()
    assert [(r.root_pos, r.id, r.level) for r in out] == [(0, "r1", 0), (0, "c1", 1), (1, "c1", 0), (1, "g1", 1)]
    with pytest.raises(ValueError):
        J.with_children(nodes, ["missing"])


def test_resolve_unique_zero_one_many(spark):
    dim = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "two")], "id string, displayName string")
    guid = "12345678-1234-1234-1234-123456789abc"
    inputs = spark.createDataFrame([(guid,), ("one",), ("two",), ("none",), (None,)], "value string")
    got = {r.value: (r.resolved_id, r.match_count, r.error) for r in J.resolve_unique(inputs, dim).collect()}
    assert got[guid] == (guid, None, None)
    assert got["one"] == ("a", 1, None)
    assert got["two"] == (None, 2, "ambiguous")
    assert got["none"] == (None, 0, "no match")
    assert got[None] == (None, 0, "no match")


def test_copy_plan_order_semantics(spark):
    reports = spark.createDataFrame([(0, 0, "x"), (0, 1, "y"), (1, 0, "x"), (1, 1, "z")],
                                    "root_pos int, report_pos long, displayName string")
    target = spark.createDataFrame([(5, "t-z2", "z"), (3, "t-z1", "z")], "pos long, id string, name string")
    plan = J.copy_plan(reports, target, order_cols=("root_pos", "report_pos"))
    got = {(r.root_pos, r.report_pos): (r.action, r.target_report_id) for r in plan.collect()}
    assert got == {(0, 0): ("clone", None), (0, 1): ("clone", None), (1, 0): ("update", None),
                   (1, 1): ("update", "t-z1")}


def test_aggregates_edge_cases(spark):
    df = spark.createDataFrame([(1.0, "2024-01-02", 5), (float("nan"), "2024-01-02", 7), (None, None, 9)],
                               "v double, WM1 string, WM2 long")
    assert A.max_column(df, "v").first().max_value == 1.0
    assert A.max_column(df.where("v is null"), "v").first().max_value is None
    assert tuple(A.max_tuple(df).first()) == ("2024-01-02", 7)
    assert tuple(A.max_tuple(df.where("false")).first()) == (None, None)
    assert A.wm_columns(spark.createDataFrame([], "WM10 int, wm2 int, WMx int")) == ["WMx", "wm2", "WM10"]
    marks = spark.createDataFrame([(3,), (8,)], "m long")
    assert A.next_watermark(marks, "m", None) == 8
    assert A.next_watermark(marks, "m", 8) == 8
    assert A.next_watermark(marks, "m", 3, high=5) == 3


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "PK1 long, PK_2 string")
    assert A.pk_columns(df) == ["PK1", "PK_2"]
    assert A.duplicate_keys(df).count() == 2
    with pytest.raises(ValueError, match="repeats"):
        A.assert_unique(df)
    A.assert_unique(df.where("PK1 = 2"))
    A.assert_unique(spark.range(3).union(spark.range(3)))  # no key columns: no check
    with pytest.raises(ValueError, match="are not among"):
        A.duplicate_keys(df, ["nope"])


def test_table_counts_unknown_on_failure(spark):
    def broken():
        return spark.read.parquet("/nonexistent/path.parquet")
    counts = {r.table_name: r.row_count for r in A.table_counts(spark, {"ok": spark.range(4), "bad": broken}).collect()}
    assert counts == {"ok": 4, "bad": None}


def test_run_outcome(spark):
    log = spark.createDataFrame([("a", 3, None), ("b", 0, "err"), ("c", 2, None)], "name string, rows long, error string")
    r = A.run_outcome(log).first()
    assert (r.units, r.failed, r.any_failed, r.rows) == (3, 1, True, 5)


def test_change_order_spreads_a_hot_key(spark):
    from tidemark.operators.joins import MARK, change_order
    o = load(spark, SF001, "orders")
    li = load(spark, SF001, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 4, F.lit(7)).otherwise(F.col("l_orderkey")))
    rows = J.change_rows(o, hot, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey", keep_mark=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df, order = change_order(rows, "l_orderkey")
        sizes = df.orderBy(*order).rdd.glom().map(len).collect()
        plain = rows.orderBy(MARK, "l_orderkey").rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot_rows = rows.where("l_orderkey = 7").count()
    assert max(plain) >= hot_rows  # without the tiebreak one task holds the hot key
    assert max(sizes) < hot_rows / 2
    ordered = [(r[MARK], r.l_orderkey) for r in df.orderBy(*order).select(MARK, "l_orderkey").collect()]
    assert ordered == sorted(ordered)


def test_change_rows_bounds_on_wall_clock_keys(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    delta = spark.createDataFrame([(1, t0)], "mark long, key timestamp_ntz")
    snap = spark.createDataFrame([(t0, "a"), (t0 + dt.timedelta(hours=9), "b")], "key timestamp_ntz, v string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = J.change_rows(delta, snap, delta_key="key", snap_key="key", mark="mark", snap_bounds=(t0, t0)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(r["__rowMarker__"], r.v) for r in got] == [(4, "a")]


def test_salted_change_rows_equal_and_spread_a_hot_key(spark):
    o = load(spark, SF001, "orders")
    li = load(spark, SF001, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 4, F.lit(7)).otherwise(F.col("l_orderkey")))
    kw = dict(delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = J.change_rows(o, hot, **kw)
        salted = J.change_rows(o, hot, salt=8, **kw)
        assert salted.count() == plain.count() and salted.exceptAll(plain).count() == 0
        present = lambda df: df.where("__rowMarker__ = 4")
        plain_sizes = present(plain).rdd.glom().map(len).collect()
        salted_sizes = present(salted).rdd.glom().map(len).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    hot_rows = hot.where("l_orderkey = 7").count()
    assert max(plain_sizes) >= hot_rows
    assert max(salted_sizes) < hot_rows / 2


def test_staged_change_rows_scan_the_snapshot_once(spark, workdir, monkeypatch):
    o, li = load(spark, SF001, "orders"), load(spark, SF001, "lineitem")
    kw = dict(delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey")
    plans = []
    staged = J._staged
    monkeypatch.setattr(J, "_staged", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, path))
    rows = J.change_rows(o, li, stage=f"{workdir}/stage", **kw)
    plans.append(rows._jdf.queryExecution().executedPlan().toString())
    assert [sum("lineitem.parquet" in x for x in p.splitlines() if "FileScan" in x) for p in plans] == [1, 0, 0]
    outer = J.change_rows(o, li, strategy="outer", **kw)
    assert rows.count() == outer.count() and rows.exceptAll(outer).count() == 0


def test_staged_change_rows_spread_a_hot_key(spark, workdir):
    """A large delta is shuffled once, and one key with most of the rows is
    split over tasks both where it is joined and where it is ordered."""
    from tidemark.operators.joins import change_order
    o, li = load(spark, SF001, "orders"), load(spark, SF001, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 4, F.lit(7)).otherwise(F.col("l_orderkey")))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = J.change_rows(o, hot, delta_key="o_orderkey", snap_key="l_orderkey", mark="o_orderkey", keep_mark=True,
                             salt=8, stage=f"{workdir}/stage")
        ordered, keys = change_order(rows, "l_orderkey")
        joined = spark.read.parquet(f"{workdir}/stage/present").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        sizes = ordered.orderBy(*keys).rdd.glom().map(len).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    hot_rows = hot.where("l_orderkey = 7").count()
    assert joined < hot_rows / 2 and max(sizes) < hot_rows / 2


def test_names_with_slashes(spark):
    from tidemark.operators.joins import change_order
    df = spark.createDataFrame([(1, "ab", 7)], "`/1FB/CURKEY_GC` long, `MANDT` string, `/1FB/CS_UNIT` int")
    spec = [{"COLUMN_NAME": "/1FB/CURKEY_GC", "DATA_TYPE": "INTEGER", "ORDINAL_POSITION": 1},
            {"COLUMN_NAME": "MANDT", "DATA_TYPE": "NVARCHAR", "CHARACTER_MAXIMUM_LENGTH": 1, "ORDINAL_POSITION": 2}]
    out = envelope(conform(df, spec, on_long_text="truncate"))
    assert out.columns == ["__watermark", "__op", "__deleted", "/1FB/CURKEY_GC", "MANDT"]
    assert tuple(out.first())[3:] == (1, "a")
    delta = spark.createDataFrame([(5, 1)], "`REQ/OUT` long, `REQ/IN` long")
    rows = J.change_rows(delta, df, delta_key="REQ/IN", snap_key="/1FB/CURKEY_GC", mark="REQ/OUT",
                         keep_mark=True, salt=2)
    ordered, keys = change_order(rows, "/1FB/CURKEY_GC")
    r = ordered.orderBy(*keys).first()
    assert (r["__rowMarker__"], r["/1FB/CURKEY_GC"], r["/1FB/CS_UNIT"]) == (4, 1, 7)


def test_places_in_groups_of_many_files(spark, workdir):
    """Groups that span files, equal rows and nulls are numbered without gaps."""
    rows = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("k"), (F.col("id") % 2).cast("int").alias("v"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = placed(rows, "g", ["k", "v"], f"{workdir}/placed")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    files = spark.read.parquet(f"{workdir}/placed").select("g", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("g").count().agg(F.min("count")).first()[0] > 1
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY g ORDER BY k NULLS LAST, v NULLS LAST) AS place FROM {rows}", rows=rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert placed(rows.limit(0), "g", ["k"], f"{workdir}/none").collect() == []


def test_schema_scope_gives_places(spark):
    from tidemark.registry import schema_scope
    rows = schema_scope(spark, SF001).collect()
    for scope in ("all", "all_by_scope", "listed", "default"):
        own = sorted((r.place, r.SCHEMA_NAME, r.c_nationkey) for r in rows if r.scope == scope)
        assert own and [r[0] for r in own] == list(range(1, len(own) + 1))
        assert [r[1:] for r in own] == sorted(r[1:] for r in own)


def test_gone_keys_are_not_packed_into_few_tasks(spark, workdir):
    """Rows of a key alone compress so well that packing by bytes would put
    most of them into a few tasks."""
    delta = spark.range(300_000).select(F.col("id").alias("key"), F.col("id").alias("mark"))
    snap = spark.range(0, 900_000).select((F.col("id") - F.col("id") % 6).alias("key"), F.col("id").alias("v"))
    kw = dict(delta_key="key", snap_key="key", mark="mark")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        lazy = J.change_rows(delta, snap, **kw)
        staged = J.change_rows(delta, snap, stage=f"{workdir}/stage", **kw)
        sizes = lazy.where("__rowMarker__ = 2").rdd.glom().map(len).collect()
        files = spark.read.parquet(f"{workdir}/stage/gone").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        outer = J.change_rows(delta, snap, strategy="outer", **kw)
        for got in (lazy, staged):
            assert got.count() == outer.count() == 550_000 and got.exceptAll(outer).count() == 0
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 250_000 and max(sizes) < 250_000 / 32 and files < 250_000 / 32
