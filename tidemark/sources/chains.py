"""Following a listing from page to page.

A listing names its next page in each page. Pages that were fetched in any
order, or stored by several fetches, are put in order by pointer doubling: in
round k every page knows the page 2^k steps on, and the pages known to be
reachable pass their place on to the ones that far ahead. So a chain of n pages
takes about log2(n) rounds of joins, whatever its order, and no task walks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NEXT_LINK_FIELDS
from ..session import scratch_dir


def next_link(body):
    """The next page a page names, null if none (or if it is no JSON object)."""
    fields = F.from_json(body, "map<string,string>")
    return F.nullif(F.coalesce(*[fields[k] for k in NEXT_LINK_FIELDS]), F.lit(""))


def follow_pages(spark: SparkSession, pages: DataFrame, start: str, *, url_col: str = "url", body_col: str = "body") -> DataFrame:
    """``url, place, status, copies, body`` of a listing that begins at ``start``.

    status `page`: a page of the listing, `place` steps from the start (0).
    status `unreached`: a page that the listing does not lead to (no place).
    status `missing`: no page, but a link that the page before `place` names.
    status `loop`: no page, but a link back to a page that came before; the
    listing ends there, and each page counts once.
    `copies` says how often a page was given; of several versions that with
    the smallest body (null last) is followed. A start without a page is `missing`.
    """
    base = scratch_dir(spark, "chain")
    body = F.min(F.struct(F.col(body_col).isNull().alias("none"), F.col(body_col).alias("body")))
    found = (pages.where(F.col(url_col).isNotNull()).groupBy(F.col(url_col).alias("url")).agg(F.count("*").alias("copies"), body.alias("b"))
             .select("url", "copies", "b.body", next_link(F.col("b.body")).alias("next")))
    found.write.parquet(f"{base}/pages")
    found = spark.read.schema(found.schema).parquet(f"{base}/pages")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    ahead = found.where("next is not null").select("url", F.col("next").alias("to"))
    placed = spark.createDataFrame([(start, 0)], "url string, place long")
    step, known = 1, 1
    while True:
        reached = placed.join(ahead, "url").select(F.col("to").alias("url"), (F.col("place") + step).alias("place"))
        placed = keep(placed.unionByName(reached).groupBy("url").agg(F.min("place").alias("place")), f"placed-{step}")
        n = placed.count()
        if n == known:
            break
        known, step = n, step * 2
        further = ahead.select(F.col("url").alias("to"), F.col("to").alias("beyond"))
        ahead = keep(ahead.join(further, "to").select("url", F.col("beyond").alias("to")), f"ahead-{step}")
    rows = found.join(placed, "url", "full").select(
        "url", "place", F.when(F.col("copies").isNull(), "missing").when(F.col("place").isNull(), "unreached").otherwise("page").alias("status"),
        F.coalesce("copies", F.lit(0)).alias("copies"), "body", "next")
    # Only the last page can lead back: all others lead to the page after them.
    back = (rows.where("status = 'page'").select("place", F.col("next").alias("url"))
            .join(placed.withColumnRenamed("place", "earlier"), "url").where(F.col("earlier") <= F.col("place")))
    loops = back.select("url", (F.col("place") + 1).alias("place"), F.lit("loop").alias("status"), F.lit(0).cast("long").alias("copies"),
                        F.lit(None).cast("string").alias("body"))
    return rows.drop("next").unionByName(loops)
