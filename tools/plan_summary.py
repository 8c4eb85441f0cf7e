"""Count shuffles, broadcasts, subqueries and scans in every registered query's plan.

Usage: python tools/plan_summary.py [sf_dir]   (plans only; only the I/O and
streaming queries execute their side-effect writes while being built)
"""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.plans.catalog import queries  # noqa: E402
from revlens.session import get_spark  # noqa: E402


def summary(plan: str) -> dict:
    phys = plan.split("== Physical Plan ==")[-1]
    return {
        "shuffle": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", phys)),
        "single": phys.count("Exchange SinglePartition"),
        "broadcast": phys.count("BroadcastExchange"),
        "subquery": len(re.findall(r"\+- Subquery subquery", phys)),
        "scans": phys.count("FileScan"),
        "partial_agg": len(re.findall(r"partial_", phys)) > 0,
    }


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    print("| query | shuffles | single-partition | broadcasts | subqueries | scans |")
    print("| --- | ---: | ---: | ---: | ---: | ---: |")
    for name, fn in sorted(queries().items()):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain()
        s = summary(buf.getvalue())
        print(f"| {name} | {s['shuffle']} | {s['single']} | {s['broadcast']} | {s['subquery']} | {s['scans']} |")
