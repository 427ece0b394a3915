"""A database table or query read in parallel over JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import BATCH_ROWS


def jdbc_source(spark: SparkSession, url: str, table_or_query: str, *, partition_column: str | None = None,
                bounds: tuple | None = None, num_partitions: int | None = None,
                fetchsize: int = BATCH_ROWS, properties: dict | None = None, predicates: list[str] | None = None) -> DataFrame:
    """Read `table_or_query` (a table name, or a SELECT in parentheses with an
    alias) with `fetchsize` rows per round trip.

    With `partition_column`, the range `bounds` is split into `num_partitions`
    stride queries that run on the executors in parallel; missing bounds are
    fetched with one MIN/MAX query that the database answers. Strides need a
    number, date or timestamp whose values are spread evenly; for other keys
    give `predicates` (see `key_bounds` and `range_predicates`), each of which
    is a query of its own. Filters and column selections on the result are
    pushed into the database query.
    """
    props = {"fetchsize": str(fetchsize), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table_or_query, predicates=predicates, properties=props)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table_or_query)
    for k, v in props.items():
        reader = reader.option(k, v)
    if partition_column is None:
        return reader.load()
    if bounds is None:
        probe = (spark.read.format("jdbc").option("url", url)
                 .option("query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                                  f"FROM {table_or_query}"))
        for k, v in (properties or {}).items():
            probe = probe.option(k, v)
        row = probe.load().first()
        bounds = (row[0], row[1])
    lo, hi = bounds
    if lo is None:
        return reader.load()
    n = num_partitions or spark.sparkContext.defaultParallelism
    return (reader.option("partitionColumn", partition_column).option("lowerBound", str(lo))
            .option("upperBound", str(hi)).option("numPartitions", str(n)).load())


def key_bounds(keys: DataFrame, column: str, n: int) -> list:
    """At most `n - 1` values that cut the non-null keys into ranges of about
    equal rows, smallest first, for a key of any type that has an order. Spark
    samples the keys to place the cuts; equal keys stay in one range."""
    key = keys.select(F.col(column).alias("k")).where("k is not null")
    first = key.repartitionByRange(n, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
    return sorted(r["k"] for r in first.collect())[1:]


def sql_literal(value) -> str:
    """A key value as standard SQL text."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, bounds: list) -> list[str]:
    """Conditions of which every row meets exactly one, null keys the first.

    Text ranges are written as "below this bound and not below any before": a
    database may order text by other rules than those that sorted the bounds,
    and this form leaves no row out, and gives none twice, in any order."""
    if not bounds:
        return ["1 = 1"]
    cuts = [sql_literal(b) for b in bounds]
    text = isinstance(bounds[0], str)

    def above(i: int) -> list[str]:
        return [f"{column} >= {c}" for c in (cuts[:i] if text else cuts[i - 1:i])]
    between = [" AND ".join([*above(i), f"{column} < {cuts[i]}"]) for i in range(1, len(cuts))]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, " AND ".join(above(len(cuts)))]


def register_jdbc_views(spark: SparkSession, url: str, tables: dict[str, dict], **common) -> list[str]:
    """Database tables as temporary views, so that exports, mirrors and
    catalogs read them like any other table. `tables` maps a view's name to
    `jdbc_source` options (`table`, by default the name itself, and the rest);
    `common` holds for all. Rows are read when a query runs."""
    for view, options in tables.items():
        options = {**common, **options}
        jdbc_source(spark, url, options.pop("table", view), **options).createOrReplaceTempView(view)
    return sorted(tables)
