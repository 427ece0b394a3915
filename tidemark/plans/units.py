"""Independent units of work (statements, feeds, groups of counts) run a few
at a time, as jobs of one Spark application."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_units(spark: SparkSession, units: list[Callable[[], object]], parallel: int = 1) -> list:
    """Results of the units, in their order. At most ``parallel`` run at once,
    each in a scheduler pool of its own, so that with the FAIR scheduler a long
    unit does not hold up short ones. A unit reports its own failure."""
    if parallel <= 1 or len(units) <= 1:
        return [u() for u in units]
    sc = spark.sparkContext

    def in_pool(k: int, unit):
        sc.setLocalProperty("spark.scheduler.pool", f"tidemark-{k % parallel}")
        try:
            return unit()
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(in_pool), k, u) for k, u in enumerate(units)]
        return [s.result() for s in started]
