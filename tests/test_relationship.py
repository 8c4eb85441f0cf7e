"""Relationships: measures at their own grain, against sums over plain Python rows."""

import contextlib
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.operators.relationship import Measure, Relationship

L, R = "k int, a string, x int", "k int, b string, y int"
ROWS = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "p", "q"]), st.sampled_from([None, 1, 5, 7])), max_size=8)


def plain(left, right, dims, where_right=None, matched=False):
    """{dims: (sum of x, rows, distinct x)} of the left table, by comparing rows one by one."""
    seen, out = [r for r in right if where_right is None or r[1] == where_right], {}
    for k, a, x in left:
        near = {r[1] for r in seen if k is not None and r[0] == k}
        if not near and (matched or where_right is not None):
            continue
        for b in (near or {None}) if "b" in dims else {None}:  # once for each value, or once in all
            out.setdefault(tuple({"a": a, "b": b}[d] for d in dims), []).append(x)
    known = {d: [x for x in rows if x is not None] for d, rows in out.items()}
    return {d: (sum(v) if v else None, len(out[d]), len(set(v))) for d, v in known.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS, st.sampled_from([["a", "b"], ["b"], ["a"], []]), st.sampled_from([None, "p"]), st.booleans())
def test_left_measures_equal_plain_sums(spark, left, right, dims, where, matched):
    rel = Relationship(spark.createDataFrame(left, L), spark.createDataFrame(right, R), ["k"], matched)
    got = rel.measures([({"a": "left", "b": "right"}[d], d) for d in dims],
                       {"s": Measure("left", "sum", "x"), "n": Measure("left", "rows"), "d": Measure("left", "distinct", "x")},
                       {"right": F.col("b") == where} if where else None).collect()
    want = plain(left, right, dims, where, matched)
    if not dims and not want:
        assert all((g.s, g.n or 0, g.d or 0) == (None, 0, 0) for g in got)
        return
    assert {tuple(g[d] for d in dims): (g.s, g.n, g.d) for g in got} == want and len(got) == len(want)


def test_both_sides_without_multiplied_sums(spark):
    left = spark.createDataFrame([(1, "a", 10)] * 3 + [(2, "a", 5)], L)
    right = spark.createDataFrame([(1, "u", 1)] * 4 + [(1, "v", 2), (3, "w", 7)], R)
    rel = Relationship(left, right, ["k"])
    asked = {"x": Measure("left", "sum", "x"), "y": Measure("right", "sum", "y"), "mean": Measure("left", "avg", "x")}
    assert [tuple(r) for r in rel.measures([], asked).collect()] == [(35, 13, 8.75)]
    by_b = {r.b: (r.x, r.y) for r in rel.measures([("right", "b")], asked).collect()}
    assert by_b == {"u": (30, 4), "v": (30, 2), None: (5, None), "w": (None, 7)}
    by_a = {r.a: (r.x, r.y) for r in rel.measures([("left", "a")], asked).collect()}
    assert by_a == {"a": (35, 6), None: (None, 7)}  # the third key's row is related to no left row


def test_an_unused_table_is_not_read(spark):
    sf = "/root/testdata/sf0.001"
    orders, events = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("orders", "events"))
    rel = Relationship(orders, events, [("o_custkey", "user_id")])

    def plan(df):
        with contextlib.redirect_stdout(buf := io.StringIO()):
            df.explain("formatted")
        return buf.getvalue()

    alone = plan(rel.measures([("left", "o_orderpriority")], {"n": Measure("left", "rows")}))
    assert "events.parquet" not in alone and "Join" not in alone
    both = plan(rel.measures([("right", "event_type")], {"n": Measure("left", "rows")}))
    assert "events.parquet" in both and both.count("Join") >= 1 and "o_totalprice" not in both.split("ReadSchema")[1]


def test_hot_key_and_odd_names(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k.1"), F.lit("a").alias("a b"), F.lit(1).alias("x"))
    right = spark.range(20_000).select(F.when(F.col("id") % 3 == 1, 1).otherwise(-F.col("id")).alias("key"), F.lit(2).alias("y"))
    out = Relationship(left, right, [("k.1", "key")]).measures(
        [("left", "a b")], {"x": Measure("left", "sum", "x"), "y": Measure("right", "sum", "y")})
    got = {r["a b"]: (r.x, r.y) for r in out.collect()}
    related = 20_000 // 3 + 1  # the rows of the hot key (0 is of both tables too)
    assert got["a"][0] == 20_000 and got["a"][1] >= 2 * (related - 1)


def test_wrong_questions():
    with pytest.raises(ValueError):
        Measure("middle", "rows")
    with pytest.raises(ValueError):
        Measure("left", "sum")
    with pytest.raises(ValueError):
        Relationship(None, None, [])
