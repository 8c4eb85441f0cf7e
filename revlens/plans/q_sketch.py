"""Queries: stored daily sketches, held against exact counts and ranks over the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sketches import RANK_ERROR, SketchStore, daily_sketches
from ..session import scratch_path
from ..sources.tables import reviews, table
from .catalog import register
from .sql import REVIEWS, with_

#: Twelve ranges of days, from one month to all years.
RANGES = {
    "all": ("1992-01-01", "2001-12-31"), "1996": ("1996-01-01", "1996-12-31"), "1998": ("1998-01-01", "1998-12-31"),
    "first half 1997": ("1997-01-01", "1997-06-30"), "spring 1995": ("1995-03-01", "1995-05-31"), "two years": ("1995-07-01", "1997-06-30"),
    "May 1996": ("1996-05-01", "1996-05-31"), "over a new year": ("1996-11-15", "1997-02-14"), "100 days": ("1997-03-01", "1997-06-08"),
    "June 1997": ("1997-06-01", "1997-06-30"), "one week": ("1995-10-02", "1995-10-08"), "last years": ("1999-01-01", "2001-12-31"),
}
SETS = {"1996 and 1998": ["1996", "1998"], "three ranges": ["1996", "1998", "last years"], "half and spring": ["first half 1997", "spring 1995"],
        "May 1996 and June 1997": ["May 1996", "June 1997"]}
RANGES_SQL = "r(name, a, b) AS (VALUES " + ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, (a, b) in RANGES.items()) + ")"


def _ranged(df, day):
    """Rows once for each range that they are in (for the exact counts)."""
    known = F.array(*[F.struct(F.lit(n).alias("range"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b"))
                      for n, (a, b) in RANGES.items()])
    hit = F.filter(known, lambda r: (r["a"] <= day) & (day <= r["b"]))
    return df.withColumn("range", F.explode(F.transform(hit, lambda r: r["range"])))


def _customers(spark, sf):
    rows = reviews(spark, sf).select("review_date", "reviewer_id")
    return rows, SketchStore.write(daily_sketches(rows, "review_date", counted="reviewer_id"), scratch_path(spark, "sketches"))


@register("customers_by_range", with_(REVIEWS).rstrip() + f""",
{RANGES_SQL}
SELECT name AS range, count(DISTINCT reviewer_id) AS customers, true AS within_bound
FROM r JOIN reviews ON review_date BETWEEN a AND b GROUP BY name""")
def q_customers_by_range(spark, sf):
    """AG15 over any range from the stored sketches, held against the exact counts."""
    rows, store = _customers(spark, sf)
    exact = _ranged(rows, F.col("review_date")).groupBy("range").agg(F.count_distinct(F.col("reviewer_id")).alias("customers"))
    return exact.join(store.distinct(RANGES), "range", "left").select(
        "range", "customers", F.coalesce(F.abs(F.col("estimate") - F.col("customers")) <= F.col("error"), F.lit(False)).alias("within_bound"))


@register("customers_in_all_ranges", with_(REVIEWS).rstrip() + f""",
{RANGES_SQL},
s(name, range) AS (VALUES {", ".join(f"('{n}', '{x}')" for n, own in SETS.items() for x in own)}),
k AS (SELECT DISTINCT s.name, s.range, reviewer_id FROM s JOIN r ON r.name = s.range JOIN reviews ON review_date BETWEEN a AND b),
c AS (SELECT k.name, reviewer_id FROM k JOIN (SELECT name, count(*) AS asked FROM s GROUP BY name) n ON n.name = k.name
      GROUP BY k.name, reviewer_id, asked HAVING count(*) = asked)
SELECT n.name, count(c.reviewer_id) AS customers, true AS within_bound FROM (SELECT DISTINCT name FROM s) n LEFT JOIN c USING (name) GROUP BY n.name""")
def q_customers_in_all_ranges(spark, sf):
    """Customers seen in each of several ranges, by intersecting sketches."""
    rows, store = _customers(spark, sf)
    seen = _ranged(rows, F.col("review_date")).select("range", "reviewer_id").distinct()
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, own)).alias("own")) for n, own in SETS.items()])
    member = F.transform(F.filter(names, lambda s: F.array_contains(s["own"], F.col("range"))), lambda s: F.struct(s["name"].alias("name"), F.size(s["own"]).alias("k")))
    met = (seen.select(F.inline(member), "reviewer_id").groupBy("name", "k", "reviewer_id").agg(F.count("*").alias("n"))
           .groupBy("name").agg(F.count(F.when(F.col("n") == F.col("k"), 1)).alias("customers")))
    estimate = store.in_all({n: [RANGES[x] for x in own] for n, own in SETS.items()})
    return met.join(estimate, "name", "left").select(
        "name", "customers", F.coalesce(F.abs(F.col("estimate") - F.col("customers")) <= F.col("error"), F.lit(False)).alias("within_bound"))


@register("quartiles_by_range", f"""WITH {RANGES_SQL}
SELECT name AS range, l_returnflag, share, count(*) AS n_rows, true AS within_bound
FROM r JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN a AND b CROSS JOIN (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS share)
GROUP BY ALL""")
def q_quartiles_by_range(spark, sf):
    """AG11 / Q6 over any range from the stored sketches: the exact rank of each quartile, within the sketch's rank error."""
    rows = table(spark, sf, "lineitem").select("l_shipdate", "l_returnflag", "l_extendedprice")
    store = SketchStore.write(daily_sketches(rows, "l_shipdate", ["l_returnflag"], measured="l_extendedprice"), scratch_path(spark, "sketches"))
    found = store.quantiles(RANGES, groups=["l_returnflag"])
    ranged = _ranged(rows, F.to_date("l_shipdate"))
    both = ranged.join(found, ["range", "l_returnflag"])
    low, high = (F.count(F.when(c, 1)) / F.count(F.lit(1)) for c in (F.col("l_extendedprice") < F.col("value"), F.col("l_extendedprice") <= F.col("value")))
    # a group of few rows has steps of one row
    room = F.lit(RANK_ERROR) + 1 / F.count(F.lit(1))
    return (both.groupBy("range", "l_returnflag", "share")
            .agg(F.count(F.lit(1)).alias("n_rows"), ((low - room <= F.first("share")) & (F.first("share") <= high + room)).alias("within_bound")))
