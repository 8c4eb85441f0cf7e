"""Grouped aggregates of the review analyses (EDA cells and BI worksheets).

Every function is a lazy transformation.  All aggregates are algebraic or
sketch-based (count, sum, avg, min/max, stddev, corr, percentile_approx), so
Spark combines them map-side before the shuffle: a key holding a third of the
rows still sends one partial row per task, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_name, month_start, weekday_name, week_part
from ..functions.scalar import (COMPLAINT_PATTERN, SENTIMENT_NEGATIVE, SENTIMENT_NEUTRAL, SENTIMENT_POSITIVE,
                                keyword_flag, sentiment_label)


def _cols(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def _key_order(keys) -> list[Column]:
    return [F.col(k).asc_nulls_first() if isinstance(k, str) else k for k in _cols(keys)]


def order_desc_limit(df: DataFrame, measure: str, keys, k: int | None = None) -> DataFrame:
    """Sort by a measure descending, ties broken by the keys, keep ``k``.

    ``orderBy`` directly followed by ``limit`` plans as TakeOrderedAndProject:
    each task keeps its own top k and only those reach the final merge.
    """
    out = df.orderBy(F.col(measure).desc_nulls_last(), *_key_order(keys))
    return out.limit(k) if k is not None else out


def top_reviewed(df: DataFrame, key: str = "asin", text_col: str | None = None,
                 k: int | None = 5, alias: str = "review_count") -> DataFrame:
    """AG1: most reviewed keys.  ``count(text)`` skips rows without text; ``None`` counts all rows."""
    cnt = F.count(text_col) if text_col else F.count(F.lit(1))
    agg = df.groupBy(key).agg(cnt.alias(alias))
    return order_desc_limit(agg, alias, key, k)


def avg_by_key(df: DataFrame, key="asin", value: str = "overall", k: int | None = None,
               alias: str = "avg_rating") -> DataFrame:
    """AG2 / AG20: average rating per key, best first."""
    agg = df.groupBy(*_cols(key)).agg(F.avg(value).alias(alias))
    return order_desc_limit(agg, alias, key, k)


def count_and_avg(df: DataFrame, key: str = "asin", text_col: str | None = None,
                  value: str = "overall", k: int | None = None) -> DataFrame:
    """AG3: count and average in one aggregate, by count descending."""
    cnt = F.count(text_col) if text_col else F.count(F.lit(1))
    agg = df.groupBy(key).agg(cnt.alias("review_count"), F.avg(value).alias("avg_rating"))
    return order_desc_limit(agg, "review_count", key, k)


def avg_by_flag(df: DataFrame, flag: str = "verified", value: str = "overall") -> DataFrame:
    """AG4: average rating per flag value; the null group is kept."""
    return df.groupBy(flag).agg(F.avg(value).alias("avg_rating"))


def polarized(df: DataFrame, key: str = "asin", rating: str = "overall", low: int = 1,
              high: int = 5, k: int | None = 5) -> DataFrame:
    """AG5: one-star and five-star counts per key, by their sum descending."""
    r = F.col(rating)
    agg = (df.filter(r.isin(low, high)).groupBy(key)
             .agg(F.count_if(r == low).alias("one_star_reviews"),
                  F.count_if(r == high).alias("five_star_reviews")))
    agg = agg.withColumn("polar_reviews", F.col("one_star_reviews") + F.col("five_star_reviews"))
    return order_desc_limit(agg, "polar_reviews", key, k)


def keyword_share(df: DataFrame, text_col: str, pattern: str = COMPLAINT_PATTERN) -> DataFrame:
    """AG6: percent of rows whose text matches, in one pass; 0 for an empty input."""
    return df.agg(F.coalesce(F.avg(keyword_flag(text_col, pattern)) * F.lit(100.0),
                             F.lit(0.0)).alias("keyword_pct"))


def trend_daily(df: DataFrame, date_col: str = "review_date", text_col: str | None = None) -> DataFrame:
    """AG7: reviews per day (count of text when given)."""
    cnt = F.count(text_col) if text_col else F.count(F.lit(1))
    return df.groupBy(F.col(date_col).alias("review_date")).agg(cnt.alias("review_count"))


def trend_monthly(df: DataFrame, date_col: str = "review_date") -> DataFrame:
    """AG8: reviews per month period; rows without a date are dropped."""
    return (df.filter(F.col(date_col).isNotNull())
              .groupBy(month_start(date_col).alias("month"))
              .agg(F.count(F.lit(1)).alias("review_count")))


def sentiment_counts(df: DataFrame, rating: str = "overall") -> DataFrame:
    """AG9: rows per sentiment label (null rating falls to Negative)."""
    return df.groupBy(sentiment_label(rating).alias("sentiment")).agg(F.count(F.lit(1)).alias("count"))


def label_frequency(df: DataFrame, col: str, k: int | None = 5) -> DataFrame:
    """AG10: most frequent values of a label column."""
    agg = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return order_desc_limit(agg, "count", col, k)


def rating_stats(df: DataFrame, col: str = "overall") -> DataFrame:
    """Q6: mean, median, mode, min, max and sample stddev of one column.

    The mode is a second aggregate (count per value, most frequent first,
    smallest value on ties) used as a scalar subquery, so no value list is
    ever held in one buffer.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    mode = counts.agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col)))).scalar()
    return df.agg(
        F.avg(col).alias("mean"),
        F.percentile_approx(col, 0.5).alias("median"),
        mode.alias("mode"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.stddev_samp(col).alias("stddev"),
    )


def box_stats(df: DataFrame, value: str, group: str | None = None, whisker: float = 1.5,
              approx_accuracy: int | None = None) -> DataFrame:
    """AG11: quartiles (linear), min, max, 1.5·IQR fences, whiskers and outliers per group (a null
    group counts as one; a null value only keeps its group).

    The rows are counted by (group, value) once; everything else reads these counts, which
    are spread over the tasks by group and value.  For a column with very many distinct values
    pass ``approx_accuracy`` (e.g. 10000): quartiles then come from a quantile sketch of fixed
    size per group over the rows.
    """
    from .lod import null_safe_join
    keys = [group] if group else []
    v, n = F.col(value), F.col("_n")
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    if approx_accuracy:
        qs = F.percentile_approx(v.cast("double"), [0.25, 0.5, 0.75], approx_accuracy)
        quart = [qs[0].alias("q1"), qs[1].alias("median"), qs[2].alias("q3")]
        source = df
    else:
        quart = [F.percentile(v, p, n).alias(name) for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
        source = counts
    q = (source.groupBy(*keys)
               .agg(*quart, F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max")))
    iqr = F.col("q3") - F.col("q1")
    q = (q.withColumn("lower_fence", F.col("q1") - F.lit(whisker) * iqr)
          .withColumn("upper_fence", F.col("q3") + F.lit(whisker) * iqr))
    if group:
        rows = null_safe_join(counts, q, keys, "inner")
    else:
        fences = q.select(F.struct("lower_fence", "upper_fence")).scalar()
        rows = counts.select(value, "_n", fences.getField("lower_fence").alias("lower_fence"),
                             fences.getField("upper_fence").alias("upper_fence"))
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    whiskers = [F.min(F.when(inside, v)).cast("double").alias("lower_whisker"),
                F.max(F.when(inside, v)).cast("double").alias("upper_whisker"),
                F.sum(F.when(v.isNotNull() & ~inside, n).otherwise(0)).alias("n_outliers")]
    if group:  # the quartiles are the same in all rows of a group
        return rows.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in q.columns if c not in keys], *whiskers)
    w = rows.agg(F.struct(*whiskers)).scalar()
    return q.select("*", *[w.getField(c).alias(c) for c in ("lower_whisker", "upper_whisker", "n_outliers")])


def length_rating_bins(df: DataFrame, length_col: str, rating_col: str, bin_width: int = 100) -> DataFrame:
    """AG12: 2-D histogram of text length against rating (the scatter, binned)."""
    b = (F.floor(F.col(length_col) / F.lit(bin_width)) * F.lit(bin_width)).cast("bigint")
    return df.groupBy(b.alias("length_bin"), F.col(rating_col)).agg(F.count(F.lit(1)).alias("count"))


def distinct_customers(df: DataFrame, date_col: str = "review_date", customer: str = "reviewer_id",
                       approx: bool = False) -> DataFrame:
    """AG15: COUNTD(customer) by year x month name (approx_count_distinct on request)."""
    cd = F.approx_count_distinct(customer) if approx else F.count_distinct(F.col(customer))
    return (df.groupBy(F.year(date_col).alias("year"), month_name(date_col).alias("month_name"))
              .agg(cd.alias("distinct_customers")))


def category_tree_avg(df: DataFrame, levels: Sequence[str], rating: str = "overall",
                      customer: str = "reviewer_id") -> DataFrame:
    """AG17: average rating and distinct customers per category path."""
    return df.groupBy(*levels).agg(F.avg(rating).alias("avg_rating"),
                                   F.count_distinct(F.col(customer)).alias("distinct_customers"))


def verified_sentiment_heat(df: DataFrame, verified: str = "verified", rating: str = "overall",
                            sentiment: Column | None = None) -> DataFrame:
    """AG18: sum(rating) and row count by verified x sentiment."""
    s = sentiment if sentiment is not None else sentiment_label(rating)
    return (df.groupBy(F.col(verified), s.alias("sentiment"))
              .agg(F.sum(rating).cast("bigint").alias("sum_rating"), F.count(F.lit(1)).alias("count")))


def verified_sentiment_pivot(df: DataFrame, verified: str = "verified", rating: str = "overall") -> DataFrame:
    """AG18 pivoted: one row per verified flag, sum and count columns per sentiment.

    The pivot values are the three fixed labels, so Spark needs no extra job to
    discover them; the pivot runs on the already aggregated rows.
    """
    labels = [SENTIMENT_POSITIVE, SENTIMENT_NEUTRAL, SENTIMENT_NEGATIVE]
    return (df.withColumn("_sentiment", sentiment_label(rating))
              .groupBy(F.col(verified))
              .pivot("_sentiment", labels)
              .agg(F.sum(rating).cast("bigint").alias("sum_rating"), F.count(F.lit(1)).alias("count")))


def helpful_vs_rating(df: DataFrame, title: str = "title", main: str = "main_category",
                      helpful: str = "helpful", rating: str = "overall") -> DataFrame:
    """AG19: sum(helpful) and sum(rating) per title x main category."""
    return (df.groupBy(title, main)
              .agg(F.sum(helpful).cast("bigint").alias("sum_helpful"),
                   F.sum(rating).cast("bigint").alias("sum_rating")))


def weekday_counts(df: DataFrame, date_col: str = "review_date") -> DataFrame:
    """AG21: rows per weekday name, most first."""
    agg = df.groupBy(weekday_name(date_col).alias("weekday")).agg(F.count(F.lit(1)).alias("count"))
    return order_desc_limit(agg, "count", "weekday")


def weekly_by_category(df: DataFrame, date_col: str = "review_date", main: str = "main_category") -> DataFrame:
    """AG22: rows per week part (all years folded) x main category."""
    return (df.groupBy(week_part(date_col).alias("week"), F.col(main))
              .agg(F.count(F.lit(1)).alias("count")))


def keyword_sentiment(df: DataFrame, keyword: str = "keyword", sentiment: str = "sentiment") -> DataFrame:
    """AG23: count(keyword) per keyword x sentiment."""
    return df.groupBy(keyword, sentiment).agg(F.count(keyword).alias("count"))


def having_range(df: DataFrame, measure: str, lo=None, hi=None) -> DataFrame:
    """AG16: keep groups whose aggregate lies in [lo, hi] (inclusive)."""
    m = F.col(measure)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (m >= F.lit(lo))
    if hi is not None:
        cond = cond & (m <= F.lit(hi))
    return df.filter(cond)


def manual_order(df: DataFrame, col: str, members, out: str = "sort_rank") -> DataFrame:
    """T4: listed members first in the listed order, every other value (and null) after them."""
    pos = F.array_position(F.array(*[F.lit(m) for m in members]), F.col(col))
    rank = F.when(pos > 0, pos).otherwise(F.lit(len(members) + 1)).cast("int")
    return df.withColumn(out, rank).orderBy(F.col(out), F.col(col).asc_nulls_last())
