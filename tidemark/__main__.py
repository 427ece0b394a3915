"""Command line for spark-submit: export, mirror, catalog and query.

    spark-submit -m tidemark export  --tables DIR --queries DIR --out DIR [--query NAME ...] [--initial NAME=MARK ...] [--parallel N]
    spark-submit -m tidemark mirror  --tables DIR --queries DIR --out DIR [--table NAME ...] [--parallel N]
    spark-submit -m tidemark catalog --tables DIR --out PATH [--database DB ...] [--views] [--map-types]
    spark-submit -m tidemark query   --tables DIR --top N "SELECT ..."

`--tables` registers every Parquet table of a folder (a `name.parquet` file
or a `name/` folder) as a view under its name; tables already in the
session catalog can be used directly, and `--jdbc URL --jdbc-table TABLE`
registers tables of a database. Exit status 3 means that a unit of work
failed (the others still ran).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def register_folder(spark: SparkSession, folder: str) -> list[str]:
    """Register each Parquet table of a folder as a temporary view."""
    from .sources import paths
    names = []
    entries = [(n, False) for n in paths.list_files(spark, folder)] + [(n, True) for n in paths.list_dirs(spark, folder)]
    for name, is_dir in sorted(entries):
        if name.startswith(("_", ".")):
            continue
        if not is_dir and not name.endswith(".parquet"):
            continue
        view = name[: -len(".parquet")] if name.endswith(".parquet") else name
        spark.read.parquet(f"{folder.rstrip('/')}/{name}").createOrReplaceTempView(view)
        names.append(view)
    return names


def jdbc_tables(texts: list[str]) -> dict[str, dict]:
    """`[VIEW=]TABLE[:KEY]` texts as options by view; a view's default name is
    the last part of the table's."""
    out = {}
    for text in texts:
        view, _, table = text.rpartition("=")
        table, _, key = table.partition(":")
        out[view or table.rpartition(".")[2]] = {"table": table, **({"partition_column": key} if key else {})}
    return out


def _report(**fields) -> None:
    """One JSON line per unit of work; facts that do not apply are left out."""
    print(json.dumps({k: v for k, v in fields.items() if v is not None}, default=str))


def _export(spark, a) -> int:
    from .plans.export import export_folder, typed_marks
    marks = {}
    for text in a.initial or []:
        name, _, values = text.partition("=")
        marks[name] = typed_marks([int(v) if v.lstrip("-").isdigit() else v for v in values.split(",")])
    results = export_folder(spark, a.queries, a.out, names=a.query or None, initial=marks, parallel=a.parallel)
    for r in results:
        _report(statement=r.name, published=r.rows, seconds=r.elapsed, failure=r.error)
    return 3 if any(r.error for r in results) else 0


def _mirror(spark, a) -> int:
    from .plans.mirror import mirror_all, specs_in_folder
    specs = specs_in_folder(spark, a.queries)
    if a.table:
        specs = [s for s in specs if s.name in set(a.table)]
        missing = set(a.table) - {s.name for s in specs}
        if missing:
            _report(folder=a.queries, unknown_tables=sorted(missing))
            return 2
    results = mirror_all(spark, specs, a.out, parallel=a.parallel)
    for r in results:
        _report(feed=r.name, run=r.mode, sequence=r.seq, change_rows=r.rows, mark=r.watermark, seconds=r.elapsed,
                failure=r.error)
    return 3 if any(r.error for r in results) else 0


def _catalog(spark, a) -> int:
    from .operators.aggregates import catalog_totals
    from .operators.nested import build_catalog
    from .plans.catalog import catalog_objects_from_session, profile
    from .sources.catalog_doc import write_catalog
    objects = catalog_objects_from_session(spark, a.database or None, all_databases=a.all_databases,
                                           include_views=a.views, include_temporary=bool(a.tables),
                                           temporary_as="table")
    entries = profile(spark, objects, include_views=a.views, map_types=a.map_types).persist()
    try:
        generated_at = dt.datetime.now().isoformat()
        if a.nested:
            write_catalog(build_catalog(entries, generated_at, include_views=a.views), a.out)
        else:
            write_catalog(entries, a.out, generated_at)
        t = catalog_totals(entries).first()
        _report(catalog=a.out, **t.asDict())
    finally:
        entries.unpersist()
    return 0


def _query(spark, a) -> int:
    from .operators.ordering import head
    from .sources.sql import query_source
    sql = open(a.file, encoding="utf-8").read() if a.file else a.sql
    if not sql or not sql.strip():
        _report(failure="give a statement or --file")
        return 2
    head(query_source(spark, sql), a.top).show(a.top, truncate=False)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--master", help="Spark master (normally given by spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    e = sub.add_parser("export", help="run *.sql files of a folder, one snapshot each")
    e.add_argument("--queries", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--query", action="append", help="only this statement (repeatable)")

    e.add_argument("--initial", action="append", metavar="NAME=MARK[,MARK...]",
                   help="marks of a statement's first run (repeatable; also initial.json in the folder)")

    m = sub.add_parser("mirror", help="one change-feed step per table folder")
    m.add_argument("--queries", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--table", action="append", help="only this table folder (repeatable)")

    for units in (e, m):
        units.add_argument("--parallel", type=int, default=1, help="units of work at a time")

    c = sub.add_parser("catalog", help="profile databases into a catalog document")
    c.add_argument("--out", required=True)
    c.add_argument("--database", action="append")
    c.add_argument("--all-databases", action="store_true")
    c.add_argument("--views", action="store_true")
    c.add_argument("--map-types", action="store_true")
    c.add_argument("--nested", action="store_true",
                   help="one nested document line per schema instead of one line per object")

    q = sub.add_parser("query", help="print the first rows of one statement")
    q.add_argument("sql", nargs="?")
    q.add_argument("--file", "-f")
    q.add_argument("--top", "-t", type=int, default=20)

    for sp in (e, m, c, q):
        sp.add_argument("--tables", help="folder of Parquet tables to register as views")

        sp.add_argument("--jdbc", metavar="URL", help="database whose tables are registered as views")
        sp.add_argument("--jdbc-table", action="append", metavar="[VIEW=]TABLE[:KEY]",
                        help="a table of that database (repeatable), read in ranges of KEY")

    a = p.parse_args(argv)
    spark = _session(a.master)
    if a.tables:
        register_folder(spark, a.tables)
    if a.jdbc:
        from .sources.jdbc import register_jdbc_views
        register_jdbc_views(spark, a.jdbc, jdbc_tables(a.jdbc_table or []))
    return {"export": _export, "mirror": _mirror, "catalog": _catalog, "query": _query}[a.command](spark, a)


if __name__ == "__main__":
    raise SystemExit(main())
