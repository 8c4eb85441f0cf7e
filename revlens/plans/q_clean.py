"""Queries: filters, null handling, flags, dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..operators.profile import describe_long
from ..sources.tables import raw_reviews, reviews, table
from .catalog import register
from .sql import NUMERIC_PREFIX, RAW_REVIEWS, REVIEWS, with_

R = with_(REVIEWS)
RAW = with_(RAW_REVIEWS)


@register("sample_rows", R + """
SELECT * FROM reviews
ORDER BY reviewer_id NULLS FIRST, asin NULLS FIRST, overall NULLS FIRST, verified NULLS FIRST, votes NULLS FIRST,
         helpful NULLS FIRST, review_date NULLS FIRST
LIMIT 5""")
def q_sample_rows(spark, sf):
    return clean.sample_rows(reviews(spark, sf), 5)


@register("keyword_flag", """
SELECT doc_id, CASE WHEN regexp_matches(text, 'refund|return|defective', 'i') THEN 1 ELSE 0 END AS contains_keyword
FROM documents""")
def q_keyword_flag(spark, sf):
    return clean.keyword_flag(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@register("malformed_rows", RAW + """
SELECT * FROM raw_reviews WHERE reviewer_id IS NULL AND asin IS NULL AND review_text IS NULL""")
def q_malformed_rows(spark, sf):
    return clean.malformed_rows(raw_reviews(spark, sf), ["reviewer_id", "asin", "review_text"])


@register("drop_missing", RAW + """
SELECT * FROM raw_reviews
WHERE reviewer_id IS NOT NULL AND asin IS NOT NULL AND review_text IS NOT NULL AND overall IS NOT NULL""")
def q_drop_missing(spark, sf):
    return clean.drop_missing(raw_reviews(spark, sf), ["reviewer_id", "asin", "review_text", "overall"])


@register("fill_missing", RAW + """
SELECT reviewer_id, asin, coalesce(review_text, 'Unknown') AS review_text, overall,
       coalesce(summary, 'No Summary') AS summary, review_date, review_ts, order_key, line_number
FROM raw_reviews""")
def q_fill_missing(spark, sf):
    return clean.fill_missing(raw_reviews(spark, sf), {"review_text": "Unknown", "summary": "No Summary"})


@register("normalize_rating", R + """
SELECT reviewer_id, asin, overall, CAST(overall AS DOUBLE) / 5.0 AS overall_normalized FROM reviews""")
def q_normalize_rating(spark, sf):
    return clean.normalize_rating(reviews(spark, sf).select("reviewer_id", "asin", "overall"))


@register("upper_outlier_filter", """
SELECT event_id, value FROM events
WHERE value <= (SELECT avg(value) + 3 * stddev_samp(value) FROM events)""")
def q_upper_outlier_filter(spark, sf):
    return clean.upper_outlier_filter(table(spark, sf, "events").select("event_id", "value"), "value", 3.0)


@register("range_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND NOT isnan(l_quantity)""")
def q_range_filter(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return clean.range_filter(li, "l_quantity", 10, 20)


@register("in_filter", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_in_filter(spark, sf):
    od = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return clean.in_filter(od, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@register("filter_all", f"""
SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders
WHERE TRY_CAST(regexp_extract(o_orderpriority, '{NUMERIC_PREFIX}', 1) AS DOUBLE) BETWEEN 2 AND 4
  AND o_totalprice BETWEEN 50000 AND 250000
  AND o_orderstatus IN ('F', 'P')""")
def q_filter_all(spark, sf):
    od = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return clean.filter_all(od, {
        "o_orderpriority": {"type": "numeric", "min": 2, "max": 4},
        "o_totalprice": {"type": "numeric", "min": 50000, "max": 250000},
        "o_orderstatus": {"type": "categorical", "selected": ["F", "P"]},
    })


@register("date_range_filter", R + """
SELECT * FROM reviews WHERE review_date BETWEEN DATE '1996-07-18' AND DATE '1997-04-21'""")
def q_date_range_filter(spark, sf):
    return clean.date_range_filter(reviews(spark, sf), "review_date", "1996-07-18", "1997-04-21")


@register("set_filter", RAW + """
SELECT * FROM raw_reviews WHERE summary IN ('N', 'R')""")
def q_set_filter(spark, sf):
    return clean.set_filter(raw_reviews(spark, sf), "summary", ["N", "R"])


@register("review_length", """
SELECT doc_id, CAST(length(text) AS INTEGER) AS review_length FROM documents""")
def q_review_length(spark, sf):
    return clean.review_length(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@register("dedup_keys", R + """
SELECT reviewer_id, asin, overall, verified, votes, helpful, review_date FROM (
  SELECT *, row_number() OVER (PARTITION BY reviewer_id, asin
                               ORDER BY review_date NULLS FIRST, overall NULLS FIRST, verified NULLS FIRST,
                                        votes NULLS FIRST, helpful NULLS FIRST) AS rn
  FROM reviews) WHERE rn = 1""")
def q_dedup_keys(spark, sf):
    return clean.dedup_keys(reviews(spark, sf), ["reviewer_id", "asin"], ["review_date"])


@register("dedup_rows", R + """
SELECT DISTINCT * FROM reviews""")
def q_dedup_rows(spark, sf):
    return clean.dedup_rows(reviews(spark, sf))


@register("manual_order", """
SELECT o_orderpriority, count(*) AS count,
       coalesce(list_position(['3-MEDIUM', '1-URGENT'], o_orderpriority), 3) AS sort_rank
FROM orders GROUP BY o_orderpriority""")
def q_manual_order(spark, sf):
    from ..operators.aggregate import manual_order
    agg = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("count"))
    return manual_order(agg, "o_orderpriority", ["3-MEDIUM", "1-URGENT"])


# What the loader run composes: fill, one row per reviewer and product, normalise, outlier filter, long statistics.
_PIPE_COLS = ["overall", "overall_normalized", "order_key", "line_number"]
_PIPE_SQL = RAW.rstrip() + """,
filled AS (SELECT * REPLACE (coalesce(review_text, 'Unknown') AS review_text, coalesce(summary, 'No Summary') AS summary)
           FROM raw_reviews),
firsts AS (SELECT * FROM filled
           QUALIFY row_number() OVER (PARTITION BY reviewer_id, asin ORDER BY order_key NULLS FIRST, line_number NULLS FIRST,
           review_text NULLS FIRST, overall NULLS FIRST, summary NULLS FIRST, review_date NULLS FIRST, review_ts NULLS FIRST) = 1),
normal AS (SELECT *, CAST(overall AS DOUBLE) / 5.0 AS overall_normalized FROM firsts),
kept AS (SELECT * FROM normal WHERE overall_normalized <=
         (SELECT avg(overall_normalized) + 3 * stddev_samp(overall_normalized) FROM normal))
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM kept" for c in _PIPE_COLS)


@register("clean_pipeline", _PIPE_SQL)
def q_clean_pipeline(spark, sf):
    df = clean.fill_missing(raw_reviews(spark, sf), {"review_text": "Unknown", "summary": "No Summary"})
    df = clean.dedup_keys(df, ["reviewer_id", "asin"], ["order_key", "line_number"])
    df = clean.upper_outlier_filter(clean.normalize_rating(df), "overall_normalized", 3.0)
    out = describe_long(df, _PIPE_COLS)
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))
