"""Connected components of a large link table, without collecting it."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir


def _place(node: Column, k: int) -> Column:
    """What nodes are ordered by in round ``k``: the node itself, and in every
    second round a hash of it that no two nodes share."""
    return node if k % 2 else F.xxhash64(node, F.lit(k))


def connected_components(spark: SparkSession, links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the smallest
    node it reaches.

    Every round moves each cluster to the first root next to it and then
    follows one more step, until no cluster moves. In odd rounds the smallest
    root is first, which settles stars at once. In even rounds roots come in a
    new random order, so that clusters merge in about log(n) rounds whatever
    the nodes are called. The last root in a round's order that still has
    another one next to it always vanishes, so the rounds end. A round is
    written as a table in the shared folder and read back, which cuts the
    lineage and survives lost executors. Hot roots only ever meet a partial
    aggregation or the streamed side of a join.
    """
    base = scratch_dir(spark, "components")
    l = links.select(F.col(a).cast("long").alias("src"), F.col(b).cast("long").alias("dst")).where("src <> dst")
    l.union(l.select("dst", "src")).distinct().write.parquet(f"{base}/links")
    edges = spark.read.schema("src long, dst long").parquet(f"{base}/links")
    schema = "node long, root long, moved boolean"
    (edges.groupBy("src").agg(F.min("dst").alias("m"))
     .select(F.col("src").alias("node"), F.least("src", "m").alias("root"), F.lit(True).alias("moved"))
     .write.parquet(f"{base}/round-0"))
    labels = spark.read.schema(schema).parquet(f"{base}/round-0")
    for k in count(1):
        first = lambda c: F.min_by(c, _place(F.col(c), k)).alias(c)
        near = (edges.join(labels.select(F.col("node").alias("dst"), F.col("root").alias("c")), "dst")
                .groupBy(F.col("src").alias("node")).agg(first("c")))
        c = F.when(_place(F.col("c"), k) < _place(F.col("root"), k), F.col("c")).otherwise(F.col("root"))
        own = labels.select("node", "root").join(near, "node").select("node", "root", c.alias("to"))
        hook = own.groupBy("root").agg(first("to"))
        # Where a cluster's goal is itself moving, go there at once.
        far = hook.select(F.col("root").alias("to"), F.col("to").alias("further"))
        hook = hook.join(far, "to", "left").select("root", F.coalesce("further", "to").alias("to"))
        (labels.select("node", "root").join(hook, "root")
         .select("node", F.col("to").alias("root"), (F.col("to") != F.col("root")).alias("moved"))
         .write.parquet(f"{base}/round-{k}"))
        labels = spark.read.schema(schema).parquet(f"{base}/round-{k}")
        if labels.where("moved").limit(1).count() == 0:
            least = labels.groupBy("root").agg(F.min("node").alias("least"))
            return labels.join(least, "root").select("node", F.col("least").alias("root"))
