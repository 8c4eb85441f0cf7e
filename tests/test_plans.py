"""Scale invariants of every registered query's physical plan.

No query may contain a cartesian product or a nested-loop join (no all-pairs
work), a row-at-a-time or Arrow Python evaluation (no Python in the hot
path), or an explicit broadcast hint (broadcasts are left to the size check).
Aggregations must combine map-side before their shuffle.
"""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod

from .conftest import SMOKE_SF

QUERIES = entry_mod.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# The ML fits run inside pyspark.ml; their transform plans are still checked.


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_invariants(spark, name):
    plan = _plan(QUERIES[name](spark, SMOKE_SF))
    physical = plan.split("== Physical Plan ==")[-1]
    for bad in FORBIDDEN:
        assert bad not in physical, f"{name}: {bad} in plan"
    assert "ResolvedHint (strategy=broadcast)" not in plan
    aggs = sum(physical.count(a) for a in ("HashAggregate(", "SortAggregate(", "ObjectHashAggregate("))
    if aggs and "Exchange hashpartitioning" in physical:
        # a shuffled aggregate comes as a map-side partial plus a final node
        assert aggs >= 2, f"{name}: aggregate without a map-side partial"


def test_scans_are_pruned(spark):
    plan = _plan(QUERIES["scan_parquet"](spark, SMOKE_SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_discount), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double" in plan
