"""Scalar column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest numeric prefix, the way a browser's parseFloat reads a string:
# optional blanks, sign, digits with an optional fraction (or a bare
# fraction), optional exponent.  Group 1 is the number without the blanks.
NUMERIC_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"

# The complaint keywords and the three sentiment labels.
COMPLAINT_PATTERN = "(?i)refund|return|defective"
SENTIMENT_POSITIVE, SENTIMENT_NEUTRAL, SENTIMENT_NEGATIVE = "Positive", "Neutral", "Negative"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_prefix(c) -> Column:
    """String -> double by prefix parse; no number at the start gives null."""
    return F.regexp_extract(_c(c).cast("string"), NUMERIC_PREFIX, 1).try_cast("double")


def coerce_numeric(c, dtype: str | None = None) -> Column:
    """Numeric columns pass through as double; strings are prefix-parsed."""
    if dtype is not None and dtype != "string":
        return _c(c).cast("double")
    return numeric_prefix(c)


def keyword_flag(c, pattern: str = COMPLAINT_PATTERN) -> Column:
    """1 when the text matches, 0 otherwise (null text included)."""
    return F.when(_c(c).rlike(pattern), F.lit(1)).otherwise(F.lit(0))


def sentiment_label(c) -> Column:
    """>= 4 positive, == 3 neutral, everything else (null too) negative."""
    r = _c(c)
    return (F.when(r >= 4, F.lit(SENTIMENT_POSITIVE))
             .when(r == 3, F.lit(SENTIMENT_NEUTRAL))
             .otherwise(F.lit(SENTIMENT_NEGATIVE)))


def helpful_ratio(helpful, votes) -> Column:
    """helpful / votes when votes > 0, else null (real division)."""
    v = _c(votes)
    return F.when(v > 0, _c(helpful).cast("double") / v.cast("double"))


def split_category(path, sep: str = "/", n_levels: int = 4, prefix: str = "level") -> list[Column]:
    """Split a category path into ``n_levels`` columns; the last one is the leaf.

    Missing levels are null; ``final`` is always the last element of the path.
    """
    parts = F.split(_c(path), F.lit(sep), -1)
    cols = [F.try_element_at(parts, F.lit(i + 1)).alias(f"{prefix}_{i + 1}") for i in range(n_levels - 1)]
    cols.append(F.try_element_at(parts, F.lit(-1)).alias(f"{prefix}_final"))
    return cols
