"""Parquet readers: column-pruned reads (S3) and change-feed reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from . import paths
from .feed_log import merged_schema, read_log, run_dir, sequences


def read_columns(spark: SparkSession, path: str, cols: list[str]) -> DataFrame | None:
    """S3: only the named columns; a missing folder or column gives None.

    The projection reaches the scan (`ReadSchema` lists just `cols`).
    """
    if not paths.exists(spark, path):
        return None
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    if any(c not in df.columns for c in cols):
        return None
    return df.select(*[df[f"`{c}`"] for c in cols])


def read_changes(spark: SparkSession, root: str, table: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The sequences of one table in `(low, high]` (default: all).
    Full-form and delta-form sequences differ in columns; they are merged by
    name, missing columns read as null, and the sequence number comes back as
    the `seq` column.

    A feed with a commit log is read from it: only the folders of committed
    sequences in the range, with the schema the log holds, so no footer is
    opened to plan the read. Folders without a log are listed and their
    schemas merged.
    """
    root = root.rstrip("/")
    log = read_log(spark, root, table)
    found = sequences(spark, root, table, log, low, high) if log else []
    if log and log.schemas:
        schema = merged_schema([log.schemas[k] for k in sorted({e[3] for e in found} or range(len(log.schemas)))])
        whole = T.StructType([*schema.fields, T.StructField("seq", T.IntegerType()), T.StructField("run", T.StringType())])
        if not found:
            return spark.createDataFrame([], whole).drop("run")
        base = f"{root}/{table}"
        return spark.read.schema(whole).option("basePath", base).parquet(*[run_dir(root, table, e[0], e[1]) for e in found]).drop("run")
    rows = spark.read.option("mergeSchema", "true").parquet(f"{root}/{table}")
    if low is not None:
        rows = rows.where(F.col("seq") > low)
    return rows if high is None else rows.where(F.col("seq") <= high)
