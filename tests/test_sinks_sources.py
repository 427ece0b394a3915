import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources import paths
from tidemark.sources.files import read_changes, read_columns
from tidemark.sources.listings import flatten_pages
from tidemark.sources.sinks import staged_write, write_change, write_parts, write_snapshot
from tidemark.sources.sql import query_source
from tidemark.tables import load, table_path

from conftest import SF001


def test_snapshot_replaces_atomically_and_skips_empty(spark, workdir):
    target = f"{workdir}/snap"
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert write_snapshot(df, target) == 10
    assert write_snapshot(df.where("id > 100"), target) == 0  # nothing new: old snapshot stays
    assert spark.read.parquet(target).count() == 10
    assert write_snapshot(df.where("id < 3"), target) == 3
    assert spark.read.parquet(target).count() == 3


def test_failed_write_keeps_old_data(spark, workdir):
    target = f"{workdir}/snap"
    write_snapshot(spark.range(5), target)
    bad = spark.range(5).withColumn("x", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        write_snapshot(bad, target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4]
    leftovers = [n for n in paths.list_dirs(spark, workdir) if n.startswith("_")]
    assert leftovers == []


def test_leftovers_of_a_killed_writer_are_hidden_and_cleared(spark, workdir):
    from tidemark.sources.files import read_changes
    from tidemark.sources.sinks import recover, write_change
    assert write_change(spark.range(10), workdir, "t", 1) == 10
    spark.range(7).write.parquet(f"{workdir}/t/_new-seq~0000000002--dead")
    assert read_changes(spark, workdir, "t").count() == 10
    # Killed between the two renames: the old data is put back.
    paths.rename(spark, f"{workdir}/t/seq=0000000001", f"{workdir}/t/_old-seq~0000000001--dead")
    recover(spark, f"{workdir}/t/seq=0000000001")
    assert read_changes(spark, workdir, "t").count() == 10
    assert write_change(spark.range(4), workdir, "t", 2) == 4
    assert paths.list_dirs(spark, f"{workdir}/t") == ["seq=0000000001", "seq=0000000002"]


def test_pages_that_are_no_json_are_one_item(spark):
    from tidemark.sources.listings import flatten_pages
    pages = spark.createDataFrame([(1, '{"value": [{"a": 1}, {"a": 2}]}'), (2, '{"value": [{"a": 3}'), (3, "<html>x</html>"), (4, " "),
                                   (5, None), (6, "17")], "page_no int, body string")
    got = [(r.page_no, r.item) for r in flatten_pages(pages).orderBy("page_no", "item_pos").collect()]
    assert got == [(1, '{"a":1}'), (1, '{"a":2}'), (2, '{"value": [{"a": 3}'), (3, "<html>x</html>"), (6, "17")]


def test_validation_discards_staged_output(spark, workdir):
    target = f"{workdir}/snap"
    write_snapshot(spark.range(2), target)

    def reject(staged):
        raise ValueError("no")

    with pytest.raises(ValueError):
        write_snapshot(spark.range(7), target, validate=reject)
    assert spark.read.parquet(target).count() == 2


def test_row_count_not_inflated_by_global_sort(spark, workdir):
    df = load(spark, SF001, "lineitem")
    n = df.count()
    metrics = {"mx": F.max("l_orderkey")}
    assert staged_write(df, f"{workdir}/a", sort_by=["l_orderkey"], metrics=metrics) == n
    assert metrics["mx"] == df.agg(F.max("l_orderkey")).first()[0]
    assert staged_write(df, f"{workdir}/b", sort_within=["l_orderkey"]) == n


def test_part_files_respect_row_limit(spark, workdir):
    df = spark.range(0, 60_000, numPartitions=1)
    out = f"{workdir}/parts"
    assert write_parts(df, out, 20_000) == 60_000
    per_file = (spark.read.parquet(out).groupBy(F.input_file_name()).count().collect())
    assert len(per_file) == 3 and all(r["count"] == 20_000 for r in per_file)


def test_change_feed_sequences_merge_schemas(spark, workdir):
    write_change(spark.createDataFrame([(0, "u", 0, 1)], "__watermark int, __op string, __deleted int, k long"),
                 workdir, "t", 1)
    write_change(spark.createDataFrame([(4, 2)], "__rowMarker__ int, k long"), workdir, "t", 2)
    assert write_change(spark.createDataFrame([], "__rowMarker__ int, k long"), workdir, "t", 3) == 0
    assert paths.list_dirs(spark, f"{workdir}/t") == ["seq=0000000001", "seq=0000000002"]
    rows = {r.seq: r for r in read_changes(spark, workdir, "t").collect()}
    assert rows[1]["__op"] == "u" and rows[1]["__rowMarker__"] is None
    assert rows[2]["__rowMarker__"] == 4 and rows[2]["__op"] is None


def test_read_columns_missing_gives_none(spark):
    path = table_path(SF001, "orders")
    assert read_columns(spark, path, ["o_orderkey"]).columns == ["o_orderkey"]
    assert read_columns(spark, path, ["nope"]) is None
    assert read_columns(spark, path + ".missing", ["o_orderkey"]) is None


def test_read_columns_prunes_scan(spark):
    df = read_columns(spark, table_path(SF001, "lineitem"), ["l_orderkey", "l_quantity"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_query_source_binds_parameters(spark):
    load(spark, SF001, "orders").createOrReplaceTempView("orders")
    named = query_source(spark, "SELECT count(*) AS n FROM orders WHERE o_orderdate > :d", {"d": dt.datetime(1900, 1, 1)})
    positional = query_source(spark, "SELECT count(*) AS n FROM orders WHERE o_orderkey > ?", [-1])
    total = load(spark, SF001, "orders").count()
    assert named.first().n == total == positional.first().n
    with pytest.raises(Exception):
        query_source(spark, "SELECT 1; SELECT 2").collect()


def _pages(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_no long, body string")


def test_flatten_pages_first_list_key_and_shapes(spark):
    pages = _pages(spark, [
        '{"count": 2, "data": [{"id": 1}, {"id": 2}], "continuationUri": "p2"}',
        '[{"id": 3}]',
        '{"data": [{"id": 4}]}',
        '{"other": 5}',
    ])
    rows = flatten_pages(pages).orderBy("page_no", "item_pos").collect()
    assert [r.item for r in rows] == ['{"id":1}', '{"id":2}', '{"id":3}', '{"id":4}', '{"other": 5}']
    assert rows[0].next_link == "p2"


def test_flatten_pages_prefers_value(spark):
    pages = _pages(spark, ['{"a": [1], "value": [{"x": 1}, {"x": 2}]}'])
    assert [r.item for r in flatten_pages(pages).collect()] == ['{"x":1}', '{"x":2}']


def test_flatten_pages_list_name_from_first_page_only(spark):
    # The first page has no list at all: later pages are taken whole.
    pages = _pages(spark, ['{"n": 1}', '{"value": [{"x": 1}]}'])
    assert [r.item for r in flatten_pages(pages).orderBy("page_no").collect()] == ['{"n": 1}', '{"value": [{"x": 1}]}']


class _Reader:
    """Stands in for the JDBC reader: records options instead of connecting."""

    def __init__(self, seen):
        self.seen = seen

    def format(self, f):
        self.seen["format"] = f
        return self

    def option(self, k, v):
        self.seen[k] = v
        return self

    def load(self):
        return self.seen


class _Session:
    def __init__(self):
        self.seen = {}
        self.sparkContext = type("SC", (), {"defaultParallelism": 8})()

    @property
    def read(self):
        return _Reader(self.seen)


def test_jdbc_source_options():
    from tidemark.sources.jdbc import jdbc_source
    s = _Session()
    opts = jdbc_source(s, "jdbc:x://h/db", "schema.t", partition_column="id", bounds=(1, 1000), num_partitions=4)
    assert opts["format"] == "jdbc" and opts["dbtable"] == "schema.t" and opts["fetchsize"] == "50000"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == \
        ("id", "1", "1000", "4")
    plain = jdbc_source(_Session(), "jdbc:x://h/db", "(SELECT 1) q", fetchsize=10)
    assert "partitionColumn" not in plain and plain["fetchsize"] == "10"


KEYS_BY_KIND = {
    "text": "concat('o\\'', lpad(cast(v * v as string), 12, 'x'))",
    "date": "date_add(date'2020-01-01', cast(v / 3 as int))",
    "decimal": "cast(pow(v, 3) / 7 as decimal(20, 4))",
    "long": "v * v - 1000",
    "timestamp": "timestampadd(SECOND, v, timestamp'2020-01-01')",
}


@pytest.mark.parametrize("kind", sorted(KEYS_BY_KIND))
def test_ranges_of_any_key_are_disjoint_and_complete(spark, kind):
    """Skewed keys with nulls, quotes and a hot key: every row meets one predicate."""
    from tidemark.sources.jdbc import key_bounds, range_predicates
    rows = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 77, id) AS v").selectExpr(
        "id", f"CASE WHEN id % 50 <> 0 THEN {KEYS_BY_KIND[kind]} END AS k")
    bounds = key_bounds(rows, "k", 8)
    assert 4 <= len(bounds) <= 7 and bounds == sorted(bounds)
    preds = range_predicates("k", bounds)
    hits = rows.select("id", *[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(preds)])
    assert hits.where(" + ".join(f"p{i}" for i in range(len(preds))) + " <> 1").count() == 0
    assert max(rows.where(p).count() for p in preds) < 1400 and range_predicates("k", []) == ["1 = 1"]


def test_text_ranges_hold_in_another_order(spark):
    """A database that orders text without regard to case."""
    from tidemark.sources.jdbc import range_predicates
    rows = spark.createDataFrame([(w,) for w in ("B", "a", "Z", "c", "b", "M", "z", "A", None)], "k string")
    preds = [p.replace("k ", "lower(k) ").replace("'B'", "'b'").replace("'M'", "'m'") for p in range_predicates("k", ["B", "M", "a", "c"])]
    assert sum(rows.where(p).count() for p in preds) == 9


def test_database_tables_become_views():
    from tidemark.__main__ import jdbc_tables
    from tidemark.sources.jdbc import register_jdbc_views
    assert jdbc_tables(["s.orders:id", "o=s.other"]) == {"orders": {"table": "s.orders", "partition_column": "id"}, "o": {"table": "s.other"}}
    made, calls = [], []

    class Frame:
        def createOrReplaceTempView(self, name):
            made.append(name)

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            calls.append((url, table, predicates, properties["fetchsize"]))
            return Frame()

    class Session:
        read = Reader()
    names = register_jdbc_views(Session(), "jdbc:x", {"t": {"table": "s.t", "predicates": ["1 = 1"]}, "u": {"predicates": ["k > 1"]}}, fetchsize=7)
    assert names == ["t", "u"] == made
    assert calls == [("jdbc:x", "s.t", ["1 = 1"], "7"), ("jdbc:x", "u", ["k > 1"], "7")]
