"""Grouped counts, units run side by side, listing chains, the nested
document, first marks of a folder, and a target workspace by name."""

import datetime as dt
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog as C
from tidemark.plans.export import export_all, export_folder, read_run_log, typed_marks
from tidemark.plans.report_copy import resolve_workspace
from tidemark.plans.units import run_units
from tidemark.sources import paths
from tidemark.sources.catalog_doc import document_lines, read_document, write_document
from tidemark.sources.chains import follow_pages
from tidemark.tables import load, table_path

from conftest import SF001


def test_many_tables_are_counted_in_groups(spark, monkeypatch):
    """A thousand tables: plans of fixed size, some tables broken."""
    sizes = []
    union = C._union_of_counts
    monkeypatch.setattr(C, "_union_of_counts", lambda ts: sizes.append(len(ts)) or union(ts))
    nation = load(spark, SF001, "nation")
    bad = spark.range(3).select(F.raise_error(F.lit("gone")).alias("x")).where("x is null")

    def absent():
        raise OSError("no such table")
    tables = {("s", f"t{i:04d}"): nation for i in range(1000)}
    tables[("s", "t0400")], tables[("s", "t0900")] = bad, absent
    start = time.perf_counter()
    rows = C.count_tables(spark, tables, group=50, jobs=4)
    took = time.perf_counter() - start
    assert [r[:2] for r in rows] == sorted(tables) and max(sizes) == 50
    assert {r[1]: r[2] for r in rows if r[2] != 25} == {"t0400": None, "t0900": None}
    assert took < 120


def test_a_group_of_counts_is_planned_quickly_and_reads_no_column(spark):
    tables = [(("s", f"t{i}"), load(spark, SF001, "lineitem")) for i in range(C.COUNT_GROUP)]
    start = time.perf_counter()
    plan = C._union_of_counts(tables)._jdf.queryExecution().executedPlan().toString()
    assert (time.perf_counter() - start) * 1000 / C.COUNT_GROUP / C.COUNT_JOBS < 20 * 4
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert scans and all("ReadSchema: struct<>" in x for x in scans)


def test_units_run_side_by_side_and_keep_their_order(spark):
    running, most, lock = [0], [0], threading.Lock()

    def unit(i):
        def run():
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.2)
            n = spark.range(i).count()
            with lock:
                running[0] -= 1
            return n
        return run
    assert run_units(spark, [unit(i) for i in range(8)], 3) == list(range(8)) and 1 < most[0] <= 3
    assert run_units(spark, [unit(i) for i in range(3)], 1) == [0, 1, 2]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_statements_side_by_side_fail_alone_with_the_same_log(spark, workdir):
    statements = {"a": "SELECT id AS PK1 FROM range(5)", "b": "SELECT nothing FROM nowhere", "c": "SELECT 1 AS PK1 FROM range(2)",
                  "d": "SELECT id AS PK1 FROM range(7)"}
    logs = []
    for parallel in (1, 3):
        out = f"{workdir}/p{parallel}"
        got = export_all(spark, statements, out, parallel=parallel)
        assert [r.name for r in got] == ["a", "b", "c", "d"]
        logs.append(sorted((r.name, r.rows, r.error is not None) for r in read_run_log(spark, f"{out}/_runs").collect()))
    assert logs[0] == logs[1] == [("a", 5, False), ("b", 0, True), ("c", 0, True), ("d", 7, False)]


def test_first_marks_of_a_folder(spark, workdir):
    load(spark, SF001, "events").createOrReplaceTempView("events")
    q = f"{workdir}/q"
    paths.write_text(spark, f"{q}/events.sql", "SELECT event_id AS PK1, event_id AS WM1, ts AS WM2 FROM events "
                                               "WHERE event_id > {WM1} AND ts > {WM2}")
    paths.write_text(spark, f"{q}/plain.sql", "SELECT 1 AS PK1")
    n = spark.table("events").count()
    assert "error" != export_folder(spark, q, f"{workdir}/none")[0].error and export_folder(spark, q, f"{workdir}/none")[0].error
    paths.write_text(spark, f"{q}/initial.json", json.dumps({"events": [-1, "1900-01-01T00:00:00"]}))
    first = {r.name: (r.rows, r.error) for r in export_folder(spark, q, f"{workdir}/out")}
    assert first == {"events": (n, None), "plain": (1, None)}
    again = {r.name: (r.rows, r.error) for r in export_folder(spark, q, f"{workdir}/out")}
    assert again["events"] == (0, None)
    given = export_folder(spark, q, f"{workdir}/given", names=["events"], initial={"events": (n // 2, dt.datetime(1900, 1, 1))})
    assert 0 < given[0].rows < n
    with pytest.raises(ValueError, match="initial marks for"):
        export_folder(spark, q, f"{workdir}/bad", initial={"evnts": (1,)})
    assert typed_marks([1, None, "2026-01-02", "2026-01-02T03:04:05", "0007", "x"]) == (
        1, None, dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5), "0007", "x")


def page(url, to=None, key="continuationUri"):
    return (url, json.dumps({"value": [url], **({key: to} if to is not None else {})}))


def chain(spark, rows, start="a"):
    got = follow_pages(spark, spark.createDataFrame(rows, "url string, body string"), start).collect()
    return sorted(((r.url, r.place, r.status, r.copies) for r in got), key=str)


def test_chains_with_gaps_loops_and_doubled_pages(spark):
    assert chain(spark, [page("c"), page("a", "b"), page("b", "c", "@odata.nextLink")]) == [
        ("a", 0, "page", 1), ("b", 1, "page", 1), ("c", 2, "page", 1)]
    assert chain(spark, [page("a", "b"), page("b", "x"), page("d", "e"), page("e")]) == [
        ("a", 0, "page", 1), ("b", 1, "page", 1), ("d", None, "unreached", 1), ("e", None, "unreached", 1), ("x", 2, "missing", 0)]
    assert chain(spark, [page("a", "b"), page("b", "c"), page("c", "b"), page("z", "z")]) == [
        ("a", 0, "page", 1), ("b", 1, "page", 1), ("b", 3, "loop", 0), ("c", 2, "page", 1), ("z", None, "unreached", 1)]
    assert chain(spark, [page("a", "a")]) == [("a", 0, "page", 1), ("a", 1, "loop", 0)]
    assert chain(spark, [page("a", "b"), page("a", "b"), page("b", ""), ("b", None), (None, "x")]) == [
        ("a", 0, "page", 2), ("b", 1, "page", 2)]
    assert chain(spark, [("b", "no json")], "a") == [("a", 0, "missing", 0), ("b", None, "unreached", 1)]
    assert chain(spark, []) == [("a", 0, "missing", 0)]


def test_long_chains_take_few_rounds(spark):
    n = 700
    rows = [page(f"u{i}", f"u{i + 1}" if i + 1 < n else None) for i in range(n)]
    pages = spark.createDataFrame(rows, "url string, body string").repartition(4, "url")
    got = {r.url: r.place for r in follow_pages(spark, pages, "u0").where("status = 'page'").collect()}
    assert got == {f"u{i}": i for i in range(n)}


def test_nested_document_of_a_large_schema(spark, workdir):
    """100,000 objects of one schema: no group holds them, several files do."""
    entry = ("named_struct('columns', array(named_struct('COLUMN_NAME', concat('c', id), 'ORDINAL_POSITION', 1L)), 'row_count', id, "
             "'access_ok', true, 'pyarrow_cols', cast(null as array<struct<name:string,type:string>>)) AS entry")
    big = spark.range(100_000).selectExpr("'big' AS schema", "if(id % 10 = 0, 'view', 'table') AS kind", "concat('o\"', id) AS object", entry)
    small = spark.range(2).selectExpr("'a{b}' AS schema", "'view' AS kind", "concat('v', id) AS object", entry)
    both = big.unionByName(small)
    plan = document_lines(both, "now")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_document(both, f"{workdir}/doc", "2026")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.text(f"{workdir}/doc").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 60_000
    local = f"{workdir}/doc".removeprefix("file:")
    import glob
    doc = json.loads("".join(open(f).read() for f in sorted(glob.glob(f"{local}/part-*"))))
    assert doc["generated_at"] == "2026" and list(doc["schemas"]) == ["a{b}", "big"]
    assert len(doc["schemas"]["big"]["tables"]) == 90_000 and len(doc["schemas"]["big"]["views"]) == 10_000
    assert doc["schemas"]["a{b}"]["tables"] == {} and set(doc["schemas"]["a{b}"]["views"]) == {"v0", "v1"}
    back = {r.schema: (len(r.tables), len(r.views)) for r in read_document(spark, f"{workdir}/doc").collect()}
    assert back == {"a{b}": (0, 2), "big": (90_000, 10_000)}
    none = both.limit(0)
    write_document(none, f"{workdir}/none", "x")
    assert read_document(spark, f"{workdir}/none").count() == 0


def test_target_workspace_by_name_or_id(spark):
    guid = "00000003-0000-4000-8000-000000000001"
    ws = spark.createDataFrame([(guid, "one"), ("i2", "two"), ("i3", "two")], "id string, displayName string")
    assert resolve_workspace(ws, "one") == guid and resolve_workspace(ws, guid.upper()) == guid.upper()
    for name, why in (("two", "ambiguous"), ("three", "no match")):
        with pytest.raises(ValueError, match=why):
            resolve_workspace(ws, name)
