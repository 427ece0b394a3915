"""Run a staged write whose tasks each fail on their first attempt; print
the observed row count and the rows read back. Used by test_retries.py in a
process of its own (task retries need a master with maxFailures > 1)."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidemark.sources.sinks import staged_write  # noqa: E402


@F.udf(returnType=T.LongType())
def fail_first_attempt(x):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("simulated lost task")
    return x


def main():
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    out = tempfile.mkdtemp(prefix="tidemark-retry-") + "/t"
    df = spark.range(0, 10_000, numPartitions=4).select(fail_first_attempt("id").alias("id"))
    n = staged_write(df, out, sort_by=["id"])
    back = spark.read.parquet(out)
    print("RESULT", n, back.count(), back.select("id").distinct().count())
    spark.stop()


if __name__ == "__main__":
    main()
