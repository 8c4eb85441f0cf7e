"""Queries: profiling, widgets, shape and data-quality summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pr
from ..sources.tables import raw_reviews, reviews, table
from .catalog import register
from .sql import NUMERIC_PREFIX, RAW_REVIEWS, REVIEWS, with_

# (column, kind) of the customer table as the profiler sees it.
_CUSTOMER = [("c_custkey", "number"), ("c_name", "text"), ("c_nationkey", "number"),
             ("c_acctbal", "number"), ("c_mktsegment", "text")]


def _profile_sql(table_name: str, cols) -> str:
    cells = []
    for c, kind in cols:
        if kind == "number":
            s, present, ok, num = f"CAST({c} AS VARCHAR)", f"{c} IS NOT NULL", "true", f"CAST({c} AS DOUBLE)"
        else:
            s = c
            present = f"({c} IS NOT NULL AND {c} <> '')"
            num = f"TRY_CAST(regexp_extract({c}, '{NUMERIC_PREFIX}', 1) AS DOUBLE)"
            ok = f"(regexp_matches({c}, '{NUMERIC_PREFIX}') AND NOT isnan({num}) AND NOT isinf({num}))"
        cells.append(f"SELECT '{c}' AS column_name, coalesce({s}, 'null') AS value, {present} AS present, "
                     f"coalesce({ok}, false) AS ok, CASE WHEN {present} AND {ok} THEN {num} END AS num FROM {table_name}")
    return f"""WITH cells AS ({' UNION ALL '.join(cells)}),
pairs AS (SELECT column_name, value, bool_or(present) AS present,
                 bool_and(CASE WHEN present THEN ok END) AS ok, min(num) AS min, max(num) AS max
          FROM cells GROUP BY column_name, value),
per_col AS (SELECT column_name, count(*) AS n_distinct, coalesce(bool_or(present), false) AS _any,
                   coalesce(bool_and(ok), true) AS _all_ok, min(min) AS min, max(max) AS max
            FROM pairs GROUP BY column_name),
prof AS (
  SELECT p.column_name, CASE WHEN _any AND _all_ok THEN 'numeric' ELSE 'categorical' END AS type, p.n_distinct,
         CASE WHEN _any AND _all_ok THEN p.min END AS min, CASE WHEN _any AND _all_ok THEN p.max END AS max
  FROM per_col p)
"""


def _profile(spark, sf):
    cu = table(spark, sf, "customer").select(*[c for c, _ in _CUSTOMER])
    return pr.profile_columns(cu)


@register("profile_columns", _profile_sql("customer", _CUSTOMER) + "SELECT * FROM prof")
def q_profile_columns(spark, sf):
    return _profile(spark, sf)


@register("profile_values", _profile_sql("customer", _CUSTOMER) + "SELECT column_name, value FROM pairs")
def q_profile_values(spark, sf):
    return pr.profile_values(table(spark, sf, "customer").select(*[c for c, _ in _CUSTOMER]))


@register("compatible_dims", _profile_sql("customer", _CUSTOMER) + "SELECT column_name FROM prof WHERE type = 'numeric'")
def q_compatible_dims(spark, sf):
    cu = table(spark, sf, "customer").select(*[c for c, _ in _CUSTOMER])
    return pr.compatible_dims(pr.profile_types(cu), "numeric")


@register("filter_widgets", _profile_sql("customer", _CUSTOMER) + """
SELECT column_name, widget, CASE WHEN widget = 'range' THEN min END AS min, CASE WHEN widget = 'range' THEN max END AS max,
       CASE WHEN widget = 'range' THEN (max - min) / 100.0 END AS step,
       CASE WHEN widget <> 'range' THEN n_distinct END AS n_options
FROM (SELECT *, CASE WHEN type = 'numeric' AND min IS NOT NULL AND max IS NOT NULL THEN 'range'
                     WHEN type = 'categorical' AND n_distinct > 0 AND n_distinct < 1000 THEN 'list' ELSE 'none' END AS widget
      FROM prof)""")
def q_filter_widgets(spark, sf):
    return pr.filter_widgets(_profile(spark, sf))


@register("coerce_numeric", f"""
SELECT o_orderkey, TRY_CAST(regexp_extract(o_orderpriority, '{NUMERIC_PREFIX}', 1) AS DOUBLE) AS o_orderpriority,
       o_orderstatus
FROM orders""")
def q_coerce_numeric(spark, sf):
    od = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return pr.coerce_numeric_columns(od, ["o_orderpriority"])


@register("row_count", with_(REVIEWS) + "SELECT count(*) AS rows, 7 AS columns FROM reviews")
def q_row_count(spark, sf):
    return pr.shape(reviews(spark, sf))


@register("approx_count", "SELECT count(*) AS rows, true AS within_bound FROM lineitem")
def q_approx_count(spark, sf):
    """Q2 held against the exact count: inside the interval of four standard errors."""
    li = table(spark, sf, "lineitem")
    rows = li.agg(F.count(F.lit(1))).scalar()
    return pr.approx_count(li, 0.1, z=4.0).select(rows.alias("rows"), rows.between(F.col("low"), F.col("high"))
                                                  .alias("within_bound"))


_RAW_COLS = ["reviewer_id", "asin", "review_text", "overall", "summary", "review_date", "review_ts",
             "order_key", "line_number"]


@register("null_counts", with_(RAW_REVIEWS) + "SELECT "
          + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _RAW_COLS) + " FROM raw_reviews")
def q_null_counts(spark, sf):
    return pr.null_counts(raw_reviews(spark, sf))


@register("null_counts_long", with_(RAW_REVIEWS) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM raw_reviews" for c in _RAW_COLS))
def q_null_counts_long(spark, sf):
    return pr.null_counts_long(raw_reviews(spark, sf))


@register("estimated_size", with_(REVIEWS) + """
SELECT count(*) AS rows, count(*) * 100 / 1048576.0 AS estimated_mb FROM reviews""")
def q_estimated_size(spark, sf):
    return pr.estimated_size(reviews(spark, sf))


_REV_COLS = [("reviewer_id", "n"), ("asin", "n"), ("overall", "n"), ("verified", "b"), ("votes", "n"),
             ("helpful", "n"), ("review_date", "d")]


def _describe_sql():
    parts = []
    for c, k in _REV_COLS:
        num = "NULL::DOUBLE" if k == "d" else f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({num}), 6) AS mean, "
                     f"round(stddev_samp({num}), 6) AS stddev, CAST(min({c}) AS VARCHAR) AS min, "
                     f"CAST(max({c}) AS VARCHAR) AS max FROM reviews")
    return with_(REVIEWS) + "\nUNION ALL\n".join(parts)


@register("describe_long", _describe_sql())
def q_describe_long(spark, sf):
    out = pr.describe_long(reviews(spark, sf))
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@register("validate_data", with_(RAW_REVIEWS) + "SELECT count(*) AS rows, "
          + "CAST(count_if(reviewer_id IS NULL AND asin IS NULL AND review_text IS NULL) AS BIGINT) AS malformed_rows, "
          + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in _RAW_COLS)
          + ", count(*) * 100 / 1048576.0 AS estimated_mb FROM raw_reviews")
def q_validate_data(spark, sf):
    return pr.validate(raw_reviews(spark, sf), ["reviewer_id", "asin", "review_text"])
