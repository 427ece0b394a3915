"""Sort (O1), ordered metadata and places in it (O2) and top-n (O3). Union with
positions (O4) is `sources.listings.union_ordered`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, *keys) -> DataFrame:
    """O1: global ascending sort; Spark range-partitions on the keys, so no
    single task sorts everything."""
    return df.orderBy(*keys)


def sorted_files(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """O1 for files: range partitions written in key order, each sorted, so
    readers can skip row groups by key."""
    parted = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return parted.sortWithinPartitions(*keys)


def ordered_metadata(df: DataFrame, *keys) -> DataFrame:
    """O2: schemas, tables and views by name; columns by position."""
    return df.orderBy(*keys)


def placed(df: DataFrame, group: str, keys: list[str], path: str) -> DataFrame:
    """O2: adds `place`, the row's number (from 1) in its group by the keys,
    nulls last. The rows are written to `path`, a fresh folder, in ranges of
    the whole order; a row's place is its place in its file after the rows of
    the files before, so no task holds a whole group."""
    order = [F.col(k).asc_nulls_last() for k in (group, *keys)] + [F.col("__tie").asc()]  # the tie splits equal rows
    ranged = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.drop("__tie").withColumn("__part", F.spark_partition_id()).write.parquet(path)
    stored = df.sparkSession.read.schema(df.withColumn("__part", F.lit(0)).schema).parquet(path)
    rows = stored.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    # One row per file and group in it.
    files = rows.groupBy(F.col(group).alias("__group"), "__part", "__file").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("__group").orderBy("__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumnRenamed("__file", "__name")
    at = F.col("__start") + F.col("__at") - F.col("__first") + 1
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__file") == F.col("__name"))
    return rows.drop("__part").join(F.broadcast(starts), same).select(*df.columns, at.alias("place"))


def head(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """O3: the first `n` rows; with an order Spark plans a top-n
    (TakeOrderedAndProject) instead of a full sort."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
