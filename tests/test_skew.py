"""Hot keys: one key holds a third or more of all rows.

Results must be whole and exact, and the aggregates must still combine
map-side (checked on the plan) so the hot key never travels as raw rows.
"""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from revlens.operators import aggregate as ag
from revlens.operators import clean, graph, lod, profile


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("asin"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 97).alias("reviewer_id"),
        ((F.col("id") % 5) + 1).cast("int").alias("overall"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("review_date"))
    return df.repartition(8)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_counts_exact(skewed):
    top = ag.top_reviewed(skewed, "asin", k=1).first()
    assert (top.asin, top.review_count) == (0, 10000)
    assert "partial_count" in _plan(ag.top_reviewed(skewed, "asin", k=1))


def test_hot_key_dedup_whole(skewed):
    d = clean.dedup_keys(skewed, ["reviewer_id"], ["review_date"])
    assert d.count() == skewed.select("reviewer_id").distinct().count()
    hot = d.filter("reviewer_id = 7").first()
    assert hot.review_date.isoformat() == "2020-01-01" and hot.asin == 0
    assert "partial_min" in _plan(d)


def test_hot_key_lod_join_whole(skewed):
    j = lod.lod_join(skewed, ["asin"], F.count(F.lit(1)))
    assert j.count() == 30000
    assert j.filter("asin = 0").select(F.min("fixed_value"), F.max("fixed_value")).first() == (10000, 10000)


def test_hot_keys_are_not_shuffled_as_rows(spark):
    """Null and one value hold most rows: their rows are joined where they stand, so no task sorts a whole key."""
    df = spark.range(30000).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("x"))
        .otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("v"))
    j = lod.lod_join(df, ["k"], F.sum("v"))
    want = {r.k: r.s for r in df.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    rows = j.collect()
    assert j.columns == ["id", "k", "v", "fixed_value"] and sorted(r.id for r in rows) == list(range(30000))
    assert all(r.fixed_value == want[r.k] for r in rows)
    assert "LeftAnti" in _plan(j) and "BroadcastHashJoin" in _plan(j)
    few = lod.lod_join(df, ["k"], F.sum("v"), hot_keys=1)  # no key is hot
    assert sorted(few.collect(), key=lambda r: r.id) == sorted(rows, key=lambda r: r.id)


def test_hot_value_profile_and_rollup(skewed):
    prof = {r.column_name: r for r in profile.profile_columns(skewed.select("asin", "overall")).collect()}
    assert prof["overall"].n_distinct == 5
    nodes = graph.hierarchy_rollup(skewed.withColumn("one", F.lit(1)), ["overall", "asin"], "one")
    assert nodes.filter("depth = 0").first().value == 30000


def test_hot_key_distinct_counts(skewed):
    out = ag.distinct_customers(skewed.withColumnRenamed("reviewer_id", "rid"), customer="rid").collect()
    assert sum(r.distinct_customers for r in out) >= 97
