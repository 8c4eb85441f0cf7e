"""Chart-ready aggregates of the review EDA, computed and exported together.

The seven charts of the analysis (top products, rating distribution, length
against rating, monthly trend, sentiment shares, verified against
unverified, rating-length correlation) as small aggregate DataFrames.  The
scatter is returned as 2-D bins, never as every point, so each output is
bounded by the number of groups, not by the number of reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import export_summary
from . import aggregate as ag
from .stats import corr_matrix


def chart_data(df: DataFrame, key: str = "asin", rating: str = "overall", text_col: str | None = "reviewText",
               date_col: str = "review_date", flag: str = "verified", top_k: int = 10,
               length_bin: int = 100) -> dict[str, DataFrame]:
    """Aggregates behind the seven charts; charts whose columns are missing are skipped."""
    cols = set(df.columns)
    out: dict[str, DataFrame] = {}
    if key in cols:
        out["top_reviewed_products"] = ag.top_reviewed(df, key, k=top_k)
    if rating in cols:
        out["review_distribution"] = ag.box_stats(df, rating)
        out["sentiment_distribution"] = ag.sentiment_counts(df, rating)
    if date_col in cols:
        out["review_trends"] = ag.trend_monthly(df, date_col)
    if flag in cols and rating in cols:
        out["verified_vs_non_verified"] = ag.avg_by_flag(df, flag, rating)
    if text_col and text_col in cols and rating in cols:
        with_len = df.withColumn("review_length", F.length(text_col))
        out["review_length_vs_rating"] = ag.length_rating_bins(with_len, "review_length", rating, length_bin)
        out["correlation_heatmap"] = corr_matrix(with_len, [rating, "review_length"])
    return out


def export_charts(df: DataFrame, path: str, fmt: str = "json", **kwargs) -> dict[str, str]:
    """I10 for the whole set: write each chart aggregate under ``path/<chart>``."""
    fixed = {"review_distribution", "sentiment_distribution", "verified_vs_non_verified", "correlation_heatmap",
             "top_reviewed_products"}  # their size does not grow with the input
    written = {}
    for name, data in chart_data(df, **kwargs).items():
        target = f"{path.rstrip('/')}/{name}"
        export_summary(data, target, fmt=fmt, single_file=name in fixed)
        written[name] = target
    return written
