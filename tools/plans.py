"""Summarise the executed physical plan of every registered query.

    python tools/plans.py [sf_dir] > PLANS.md

Each query is run through its own query execution so that AQE's final plan is shown:
number of scans, shuffle exchanges, broadcast exchanges and join kinds, and
the pushed filters and read schemas of its Parquet scans.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.registry import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def final_tree(text: str) -> str:
    """The operator tree that ran: AQE's final plan, or the only tree."""
    if "== Final Plan ==" in text:
        return text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text.split("\n\n", 1)[0]


def summary(text: str) -> dict:
    nodes = re.findall(r"^[\s:+\-*|]*([A-Z]\w+)", final_tree(text), re.M)
    count = lambda k: sum(1 for n in nodes if n == k)
    pushed = sorted(set(re.findall(r"PushedFilters: \[(.+)\]", text)))
    final = "isFinalPlan=true" in text
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*>)", text)))
    return {
        "scans": count("Scan") + count("FileScan"),
        "shuffles": count("Exchange"),
        "broadcasts": count("BroadcastExchange"),
        "joins": sorted({n for n in nodes if n.endswith("Join")}),
        "aggregates": sorted({n for n in nodes if n.endswith("Aggregate")}),
        "codegen": "WholeStageCodegen" in text or "[codegen id" in text,
        "final": final,
        "pushed": pushed,
        "schemas": schemas,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    print(f"# Physical plans (executed, AQE final) at `{os.path.basename(sf.rstrip('/'))}`\n")
    print("Generated by `tools/plans.py`. Per query: scans, shuffle exchanges, broadcast exchanges,")
    print("join and aggregate operators, and what reached the Parquet scans.\n")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        # Run the frame's own query execution on the JVM (no rows go to
        # Python) so that AQE's plan is final when explained.
        df._jdf.queryExecution().toRdd().count()
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summary(buf.getvalue())
        print(f"## {name}\n")
        print(f"- scans {s['scans']}, shuffles {s['shuffles']}, broadcasts {s['broadcasts']}, "
              f"whole-stage codegen {'yes' if s['codegen'] else 'no'}, final AQE plan {'yes' if s['final'] else 'no'}")
        print(f"- joins: {', '.join(s['joins']) or 'none'}; aggregates: {', '.join(s['aggregates']) or 'none'}")
        for p in s["pushed"]:
            print(f"- pushed: `[{p}]`")
        for r in s["schemas"]:
            print(f"- read: `{r}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
