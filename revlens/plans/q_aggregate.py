"""Queries over the derived review rows: EDA aggregates and BI worksheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_epoch_seconds, epoch_date, month_name, month_start, parse_review_time, week_part, weekday_name
from ..operators import aggregate as ag
from ..operators import clean
from ..operators.lod import null_safe_join
from ..sources.tables import raw_reviews, reviews
from .catalog import register
from .sql import RAW_REVIEWS, REVIEWS, REVIEWS_CAT, WEEK_PART, with_

R = with_(REVIEWS)
RC = with_(REVIEWS_CAT)


@register("top_reviewed", R + """
SELECT asin, count(*) AS review_count FROM reviews
GROUP BY asin ORDER BY review_count DESC, asin LIMIT 10""")
def q_top_reviewed(spark, sf):
    return ag.top_reviewed(reviews(spark, sf), "asin", k=10)


@register("avg_by_key", R + """
SELECT asin, avg(overall) AS avg_rating FROM reviews GROUP BY asin""")
def q_avg_by_key(spark, sf):
    return ag.avg_by_key(reviews(spark, sf), "asin", "overall")


@register("count_and_avg", R + """
SELECT asin, count(*) AS review_count, avg(overall) AS avg_rating FROM reviews GROUP BY asin""")
def q_count_and_avg(spark, sf):
    return ag.count_and_avg(reviews(spark, sf), "asin", value="overall")


@register("avg_by_verified", R + """
SELECT verified, avg(overall) AS avg_rating FROM reviews GROUP BY verified""")
def q_avg_by_verified(spark, sf):
    return ag.avg_by_flag(reviews(spark, sf), "verified", "overall")


@register("polarized", R + """
SELECT asin, CAST(count_if(overall = 1) AS BIGINT) AS one_star_reviews,
       CAST(count_if(overall = 5) AS BIGINT) AS five_star_reviews,
       CAST(count_if(overall = 1) + count_if(overall = 5) AS BIGINT) AS polar_reviews
FROM reviews WHERE overall IN (1, 5) GROUP BY asin
ORDER BY polar_reviews DESC, asin LIMIT 10""")
def q_polarized(spark, sf):
    return ag.polarized(reviews(spark, sf), "asin", "overall", k=10)


@register("trend_daily", R + """
SELECT review_date, count(*) AS review_count FROM reviews GROUP BY review_date""")
def q_trend_daily(spark, sf):
    return ag.trend_daily(reviews(spark, sf), "review_date")


@register("trend_monthly", R + """
SELECT CAST(date_trunc('month', review_date) AS DATE) AS month, count(*) AS review_count
FROM reviews WHERE review_date IS NOT NULL GROUP BY 1""")
def q_trend_monthly(spark, sf):
    return ag.trend_monthly(reviews(spark, sf), "review_date")


@register("sentiment_counts", R + """
SELECT CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral' ELSE 'Negative' END
       AS sentiment, count(*) AS count
FROM reviews GROUP BY 1""")
def q_sentiment_counts(spark, sf):
    return ag.sentiment_counts(reviews(spark, sf), "overall")


@register("rating_stats", R + """
SELECT avg(overall) AS mean, quantile_disc(overall, 0.5) AS median,
       (SELECT overall FROM reviews WHERE overall IS NOT NULL GROUP BY overall
        ORDER BY count(*) DESC, overall LIMIT 1) AS mode,
       min(overall) AS min, max(overall) AS max, round(stddev_samp(overall), 9) AS stddev
FROM reviews""")
def q_rating_stats(spark, sf):
    df = ag.rating_stats(reviews(spark, sf), "overall")
    return df.withColumn("stddev", F.round("stddev", 9))


@register("box_stats", RC.rstrip() + """
, q AS (
  SELECT main_category, quantile_cont(votes, 0.25) AS q1, quantile_cont(votes, 0.5) AS median,
         quantile_cont(votes, 0.75) AS q3, CAST(min(votes) AS DOUBLE) AS min, CAST(max(votes) AS DOUBLE) AS max
  FROM reviews GROUP BY main_category),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.*, CAST(min(CASE WHEN r.votes BETWEEN f.lower_fence AND f.upper_fence THEN r.votes END) AS DOUBLE) AS lower_whisker,
       CAST(max(CASE WHEN r.votes BETWEEN f.lower_fence AND f.upper_fence THEN r.votes END) AS DOUBLE) AS upper_whisker,
       CAST(count_if(r.votes IS NOT NULL AND NOT (r.votes BETWEEN f.lower_fence AND f.upper_fence)) AS BIGINT)
         AS n_outliers
FROM f JOIN reviews r ON r.main_category = f.main_category
GROUP BY ALL""")
def q_box_stats(spark, sf):
    return ag.box_stats(reviews(spark, sf, categories=True), "votes", group="main_category")


@register("distinct_customers", R + """
SELECT CAST(year(review_date) AS INTEGER) AS year, monthname(review_date) AS month_name,
       count(DISTINCT reviewer_id) AS distinct_customers
FROM reviews GROUP BY 1, 2""")
def q_distinct_customers(spark, sf):
    return ag.distinct_customers(reviews(spark, sf))


@register("category_tree_avg", RC + """
SELECT main_category, sub_category, sub_sub_category, final_category,
       avg(overall) AS avg_rating, count(DISTINCT reviewer_id) AS distinct_customers
FROM reviews GROUP BY 1, 2, 3, 4""")
def q_category_tree_avg(spark, sf):
    return ag.category_tree_avg(reviews(spark, sf, categories=True),
                                ["main_category", "sub_category", "sub_sub_category", "final_category"])


@register("verified_sentiment_heat", R + """
SELECT verified,
       CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral' ELSE 'Negative' END AS sentiment,
       CAST(sum(overall) AS BIGINT) AS sum_rating, count(*) AS count
FROM reviews GROUP BY 1, 2""")
def q_verified_sentiment_heat(spark, sf):
    return ag.verified_sentiment_heat(reviews(spark, sf))


@register("helpful_vs_rating", RC + """
SELECT title, main_category, CAST(sum(helpful) AS BIGINT) AS sum_helpful,
       CAST(sum(overall) AS BIGINT) AS sum_rating
FROM reviews GROUP BY 1, 2""")
def q_helpful_vs_rating(spark, sf):
    return ag.helpful_vs_rating(reviews(spark, sf, categories=True))


@register("avg_by_main_category", RC + """
SELECT main_category, avg(overall) AS avg_rating FROM reviews GROUP BY 1""")
def q_avg_by_main_category(spark, sf):
    return ag.avg_by_key(reviews(spark, sf, categories=True), "main_category", "overall")


@register("weekday_counts", R + """
SELECT dayname(review_date) AS weekday, count(*) AS count FROM reviews GROUP BY 1""")
def q_weekday_counts(spark, sf):
    return ag.weekday_counts(reviews(spark, sf))


@register("weekly_by_category", RC + f"""
SELECT {WEEK_PART.format(d='review_date')} AS week, main_category, count(*) AS count
FROM reviews GROUP BY 1, 2""")
def q_weekly_by_category(spark, sf):
    return ag.weekly_by_category(reviews(spark, sf, categories=True))


@register("having_range", R + """
SELECT asin, count(*) AS review_count FROM reviews GROUP BY asin
HAVING count(*) BETWEEN 28 AND 40""")
def q_having_range(spark, sf):
    agg = reviews(spark, sf).groupBy("asin").agg(F.count(F.lit(1)).alias("review_count"))
    return ag.having_range(agg, "review_count", 28, 40)


@register("order_desc_limit", R + """
SELECT reviewer_id, avg(overall) AS avg_rating FROM reviews GROUP BY reviewer_id
ORDER BY avg_rating DESC, reviewer_id LIMIT 20""")
def q_order_desc_limit(spark, sf):
    return ag.avg_by_key(reviews(spark, sf), "reviewer_id", "overall", k=20)


@register("distinct_customers_approx", R + """
SELECT CAST(year(review_date) AS INTEGER) AS year, monthname(review_date) AS month_name,
       count(DISTINCT reviewer_id) AS distinct_customers, true AS within_bound
FROM reviews GROUP BY 1, 2""")
def q_distinct_customers_approx(spark, sf):
    """AG15 with the HyperLogLog++ sketch, held against the exact counts: five standard errors (5 % each) at most."""
    r = reviews(spark, sf)
    sketch = ag.distinct_customers(r, approx=True).withColumnRenamed("distinct_customers", "estimate")
    both = null_safe_join(ag.distinct_customers(r), sketch, ["year", "month_name"], "inner")
    return both.select("year", "month_name", "distinct_customers",
                       (F.abs(F.col("estimate") - F.col("distinct_customers"))
                        <= F.lit(0.25) * F.col("distinct_customers")).alias("within_bound"))


@register("category_tree_filtered", RC + """
SELECT main_category, sub_category, sub_sub_category, final_category,
       avg(overall) AS avg_rating, count(DISTINCT reviewer_id) AS distinct_customers
FROM reviews GROUP BY 1, 2, 3, 4
HAVING avg(overall) BETWEEN 2.5 AND 3.5 AND count(DISTINCT reviewer_id) BETWEEN 20 AND 40""")
def q_category_tree_filtered(spark, sf):
    """AG17 with the sheet's two measure ranges."""
    tree = ag.category_tree_avg(reviews(spark, sf, categories=True),
                                ["main_category", "sub_category", "sub_sub_category", "final_category"])
    return ag.having_range(ag.having_range(tree, "avg_rating", 2.5, 3.5), "distinct_customers", 20, 40)


@register("verified_sentiment_filtered", R + """
SELECT verified,
       CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral' ELSE 'Negative' END AS sentiment,
       CAST(sum(overall) AS BIGINT) AS sum_rating, count(*) AS count
FROM reviews WHERE overall BETWEEN 2 AND 5 AND verified IN (true) GROUP BY 1, 2""")
def q_verified_sentiment_filtered(spark, sf):
    """AG18 with the sheet's rating range and verified set."""
    kept = clean.set_filter(clean.range_filter(reviews(spark, sf), "overall", 2, 5), "verified", [True])
    return ag.verified_sentiment_heat(kept)


@register("date_parts", R + f"""
SELECT reviewer_id, asin, review_date,
       CAST(year(review_date) AS INTEGER) AS year, CAST(quarter(review_date) AS INTEGER) AS quarter,
       CAST(month(review_date) AS INTEGER) AS month, CAST(day(review_date) AS INTEGER) AS day,
       {WEEK_PART.format(d='review_date')} AS week, monthname(review_date) AS month_name,
       dayname(review_date) AS weekday, CAST(date_trunc('month', review_date) AS DATE) AS month_start,
       CAST(epoch(CAST(review_date AS TIMESTAMP)) AS BIGINT) AS epoch_seconds,
       review_date AS epoch_round_trip,
       review_date AS parsed_review_time
FROM reviews""")
def q_date_parts(spark, sf):
    d = F.col("review_date")
    epoch = date_epoch_seconds(d)
    text = F.date_format(d, "MM d, yyyy")
    return reviews(spark, sf).select(
        "reviewer_id", "asin", "review_date",
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), week_part(d).alias("week"), month_name(d).alias("month_name"),
        weekday_name(d).alias("weekday"), month_start(d).alias("month_start"),
        epoch.alias("epoch_seconds"), epoch_date(epoch).alias("epoch_round_trip"),
        parse_review_time(text).alias("parsed_review_time"))


@register("top_reviewed_text", with_(RAW_REVIEWS) + """
SELECT asin, count(review_text) AS review_count FROM raw_reviews
GROUP BY asin ORDER BY review_count DESC, asin NULLS FIRST LIMIT 10""")
def q_top_reviewed_text(spark, sf):
    """AG1 as written: count of non-null review text per product (null product is a group)."""
    return ag.top_reviewed(raw_reviews(spark, sf), "asin", text_col="review_text", k=10)


@register("trend_daily_text", with_(RAW_REVIEWS) + """
SELECT review_date, count(review_text) AS review_count FROM raw_reviews GROUP BY review_date""")
def q_trend_daily_text(spark, sf):
    """AG7 as written: non-null review texts per day."""
    return ag.trend_daily(raw_reviews(spark, sf), "review_date", text_col="review_text")


@register("sentiment_counts_nulls", with_(RAW_REVIEWS) + """
SELECT CASE WHEN overall >= 4 THEN 'Positive' WHEN overall = 3 THEN 'Neutral' ELSE 'Negative' END
       AS sentiment, count(*) AS count
FROM raw_reviews GROUP BY 1""")
def q_sentiment_counts_nulls(spark, sf):
    """AG9 over ratings with nulls: a null rating falls to Negative."""
    return ag.sentiment_counts(raw_reviews(spark, sf), "overall")


@register("verified_sentiment_pivot", R + """
SELECT verified, CAST(sum(CASE WHEN overall >= 4 THEN overall END) AS BIGINT) AS Positive_sum_rating,
       CASE WHEN count_if(overall >= 4) > 0 THEN CAST(count_if(overall >= 4) AS BIGINT) END AS Positive_count,
       CAST(sum(CASE WHEN overall = 3 THEN overall END) AS BIGINT) AS Neutral_sum_rating,
       CASE WHEN count_if(overall = 3) > 0 THEN CAST(count_if(overall = 3) AS BIGINT) END AS Neutral_count,
       CAST(sum(CASE WHEN NOT (coalesce(overall >= 4, false) OR coalesce(overall = 3, false)) THEN overall END) AS BIGINT) AS Negative_sum_rating,
       CASE WHEN count_if(NOT (coalesce(overall >= 4, false) OR coalesce(overall = 3, false))) > 0 THEN CAST(count_if(NOT (coalesce(overall >= 4, false) OR coalesce(overall = 3, false))) AS BIGINT) END AS Negative_count
FROM reviews GROUP BY verified""")
def q_verified_sentiment_pivot(spark, sf):
    """AG18 in its pivoted (heat-map) form."""
    return ag.verified_sentiment_pivot(reviews(spark, sf))
