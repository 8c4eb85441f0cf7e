"""Queries: fixed-LOD sheets, spikes, correlations, z-scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lod, stats
from ..operators.aggregate import box_stats
from ..sources.tables import raw_reviews, reviews, table, text_reviews
from .catalog import register
from .sql import RAW_REVIEWS, REVIEWS, TEXT_REVIEWS, with_

R = with_(REVIEWS)


@register("lod_daily", R.rstrip() + """
, fixed AS (SELECT review_date, count(reviewer_id) AS _fixed FROM reviews GROUP BY review_date),
view AS (SELECT DISTINCT CAST(year(review_date) AS INTEGER) AS year, CAST(quarter(review_date) AS INTEGER) AS quarter,
                CAST(month(review_date) AS INTEGER) AS month, CAST(day(review_date) AS INTEGER) AS day, review_date
         FROM reviews WHERE overall = 5)
SELECT year, quarter, month, day, CAST(sum(_fixed) AS BIGINT) AS value
FROM view JOIN fixed USING (review_date) GROUP BY 1, 2, 3, 4
HAVING sum(_fixed) BETWEEN 20 AND 40""")
def q_lod_daily(spark, sf):
    d = F.col("review_date")
    return lod.fixed_lod(
        reviews(spark, sf), ["review_date"], F.count("reviewer_id"),
        [F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
         F.dayofmonth(d).alias("day")],
        where=F.col("overall") == 5, having=(20, 40))


@register("lod_per_customer", R + """
SELECT reviewer_id, count(asin) AS value FROM reviews GROUP BY reviewer_id""")
def q_lod_per_customer(spark, sf):
    return lod.lod_per_key(reviews(spark, sf), "reviewer_id", F.count("asin"))


@register("lod_join", R.rstrip() + """
, f AS (SELECT review_date, count(*) AS fixed_value FROM reviews GROUP BY review_date)
SELECT r.*, f.fixed_value FROM reviews r LEFT JOIN f ON r.review_date = f.review_date""")
def q_lod_join(spark, sf):
    return lod.lod_join(reviews(spark, sf), ["review_date"], F.count(F.lit(1)))


RAW = with_(RAW_REVIEWS)


@register("lod_join_nulls", RAW.rstrip() + """
, f AS (SELECT asin, count(*) AS fixed_value FROM raw_reviews GROUP BY asin)
SELECT r.order_key, r.line_number, r.asin, f.fixed_value FROM raw_reviews r LEFT JOIN f ON r.asin IS NOT DISTINCT FROM f.asin""")
def q_lod_join_nulls(spark, sf):
    df = raw_reviews(spark, sf).select("order_key", "line_number", "asin")
    return lod.lod_join(df, ["asin"], F.count(F.lit(1)))


@register("lod_daily_nulls", RAW.rstrip() + """
, fixed AS (SELECT reviewer_id, count(*) AS _fixed FROM raw_reviews GROUP BY reviewer_id),
view AS (SELECT DISTINCT overall, reviewer_id FROM raw_reviews)
SELECT overall, CAST(sum(_fixed) AS BIGINT) AS value
FROM view v JOIN fixed f ON v.reviewer_id IS NOT DISTINCT FROM f.reviewer_id GROUP BY overall""")
def q_lod_daily_nulls(spark, sf):
    return lod.fixed_lod(raw_reviews(spark, sf), ["reviewer_id"], F.count(F.lit(1)), [F.col("overall")])


@register("box_stats_nulls", RAW.rstrip() + """
, q AS (
  SELECT summary, quantile_cont(overall, 0.25) AS q1, quantile_cont(overall, 0.5) AS median,
         quantile_cont(overall, 0.75) AS q3, CAST(min(overall) AS DOUBLE) AS min, CAST(max(overall) AS DOUBLE) AS max
  FROM raw_reviews GROUP BY summary),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.*, CAST(min(CASE WHEN r.overall BETWEEN f.lower_fence AND f.upper_fence THEN r.overall END) AS DOUBLE) AS lower_whisker,
       CAST(max(CASE WHEN r.overall BETWEEN f.lower_fence AND f.upper_fence THEN r.overall END) AS DOUBLE) AS upper_whisker,
       CAST(count_if(r.overall IS NOT NULL AND NOT (r.overall BETWEEN f.lower_fence AND f.upper_fence)) AS BIGINT)
         AS n_outliers
FROM f JOIN raw_reviews r ON r.summary IS NOT DISTINCT FROM f.summary
GROUP BY ALL""")
def q_box_stats_nulls(spark, sf):
    return box_stats(raw_reviews(spark, sf), "overall", group="summary")


@register("spike_days_band", R + """
SELECT review_date AS day, count(*) AS day_count FROM reviews GROUP BY 1
HAVING count(*) BETWEEN 40 AND 60""")
def q_spike_days_band(spark, sf):
    return lod.spike_days_band(reviews(spark, sf), "review_date", 40, 60)


@register("spike_days", R.rstrip() + """
, d AS (SELECT review_date AS day, count(*) AS day_count FROM reviews GROUP BY 1)
SELECT day, day_count, round(avg(day_count) OVER w, 6) AS trailing_mean,
       round(stddev_samp(day_count) OVER w, 6) AS trailing_sd,
       coalesce(day_count > avg(day_count) OVER w + 2 * stddev_samp(day_count) OVER w, false) AS is_spike
FROM d WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)""")
def q_spike_days(spark, sf):
    out = lod.spike_days_z(reviews(spark, sf), "review_date", k=2.0, trailing=28)
    return (out.withColumn("trailing_mean", F.round("trailing_mean", 6))
               .withColumn("trailing_sd", F.round("trailing_sd", 6)))


@register("corr_pair", with_(TEXT_REVIEWS) + """
SELECT round(corr(CAST(length(text) AS DOUBLE), CAST(quality AS DOUBLE)), 9) AS correlation FROM text_reviews""")
def q_corr_pair(spark, sf):
    df = text_reviews(spark, sf).withColumn("review_length", F.length("text"))
    return stats.corr_pair(df, "review_length", "quality").select(F.round("correlation", 9).alias("correlation"))


@register("corr_two", with_(TEXT_REVIEWS) + """
SELECT round(corr(CAST(toxic AS DOUBLE), CAST(length(text) AS DOUBLE)), 9) AS correlation FROM text_reviews""")
def q_corr_two(spark, sf):
    df = text_reviews(spark, sf).withColumn("review_length", F.length("text"))
    return stats.corr_pair(df, "toxic", "review_length").select(F.round("correlation", 9).alias("correlation"))


_CM_COLS = ["overall", "verified_int", "votes"]


def _corr_matrix_sql():
    cells = []
    for i, a in enumerate(_CM_COLS):
        for b in _CM_COLS:
            cells.append(f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS r FROM m")
    return (R.rstrip() + "\n, m AS (SELECT overall, CAST(verified AS INTEGER) AS verified_int, votes FROM reviews)\n"
            + "\nUNION ALL\n".join(cells))


@register("corr_matrix", _corr_matrix_sql())
def q_corr_matrix(spark, sf):
    df = reviews(spark, sf).select("overall", F.col("verified").cast("int").alias("verified_int"), "votes")
    return stats.corr_matrix(df, _CM_COLS).withColumn("r", F.round("r", 9))


@register("zscore_flag", """
SELECT event_id, value,
       coalesce((value - (SELECT avg(value) FROM events)) / nullif((SELECT stddev_samp(value) FROM events), 0) > 2, false)
       AS is_anomaly
FROM events""")
def q_zscore_flag(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return stats.zscore_flag(ev, "value", 2.0)


@register("scalar_broadcast", """
SELECT event_id, round(value - (SELECT avg(value) FROM events), 6) AS deviation,
       round((SELECT avg(value) FROM events), 6) AS mean, round((SELECT stddev_samp(value) FROM events), 6) AS sd
FROM events""")
def q_scalar_broadcast(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    st = ev.agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    out = stats.scalar_broadcast(ev, st)
    return out.select("event_id", F.round(F.col("value") - F.col("mean"), 6).alias("deviation"),
                      F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@register("helpful_ratio", R + """
SELECT reviewer_id, asin, helpful, votes, CASE WHEN votes > 0 THEN CAST(helpful AS DOUBLE) / votes END AS helpful_ratio
FROM reviews""")
def q_helpful_ratio(spark, sf):
    df = reviews(spark, sf).select("reviewer_id", "asin", "helpful", "votes")
    return stats.helpful_ratio(df)
