"""Print the formatted physical plan of registered queries: python tools/explain.py name [sf_dir]."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.plans.catalog import queries  # noqa: E402
from revlens.session import get_spark  # noqa: E402

if __name__ == "__main__":
    names = sys.argv[1].split(",")
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    for n in names:
        print(f"===== {n}")
        queries()[n](spark, sf).explain(os.environ.get("MODE", "formatted"))
