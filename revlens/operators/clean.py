"""Row-level cleaning: filters, null handling, flags, lengths and dedup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import COMPLAINT_PATTERN, keyword_flag as _keyword_flag
from .stats import global_stats


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (all columns when none is given)."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in keys]).limit(n)


def keyword_flag(df: DataFrame, text_col: str, pattern: str = COMPLAINT_PATTERN,
                 out: str = "contains_keyword") -> DataFrame:
    """P10: 1 when the text matches ``pattern`` (case-insensitive by default), else 0."""
    return df.withColumn(out, _keyword_flag(text_col, pattern))


def malformed_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every one of ``cols`` is null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return df.filter(cond)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def normalize_rating(df: DataFrame, col: str = "overall", scale: float = 5.0,
                     out: str = "overall_normalized") -> DataFrame:
    """Rating divided by the scale maximum."""
    return df.withColumn(out, F.col(col).cast("double") / F.lit(float(scale)))


def upper_outlier_filter(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Keep rows with ``col <= mean + k * sd`` (statistics of the same input)."""
    st = global_stats(df, col)
    return df.filter(F.col(col) <= st["mean"] + F.lit(k) * st["sd"])


def range_filter(df: DataFrame, col: str, lo=None, hi=None, numeric=None) -> DataFrame:
    """P5: inclusive numeric range; null and NaN rows are dropped even at full range.

    ``numeric`` is the value expression (a prefix parse for string columns);
    by default the column is cast to double.
    """
    v = numeric if numeric is not None else F.col(col).cast("double")
    cond = v.isNotNull() & ~F.isnan(v)
    if lo is not None:
        cond = cond & (v >= F.lit(lo))
    if hi is not None:
        cond = cond & (v <= F.lit(hi))
    return df.filter(cond)


def in_filter(df: DataFrame, col: str, values: Sequence | None) -> DataFrame:
    """Membership on the string form; null matches the value ``"null"``; empty = no filter."""
    if not values:
        return df
    return df.filter(F.coalesce(F.col(col).cast("string"), F.lit("null")).isin([str(v) for v in values]))


def filter_all(df: DataFrame, specs: Mapping[str, Mapping]) -> DataFrame:
    """AND of per-column specs ``{col: {"type": "numeric", "min":, "max":}}`` or
    ``{col: {"type": "categorical", "selected": [...]}}``; no specs = the input."""
    from ..functions.scalar import coerce_numeric
    dtypes = dict(df.dtypes)
    for col, spec in specs.items():
        if spec.get("type") == "numeric":
            df = range_filter(df, col, spec.get("min"), spec.get("max"),
                              numeric=coerce_numeric(col, dtypes.get(col)))
        elif spec.get("type") == "categorical":
            df = in_filter(df, col, spec.get("selected"))
    return df


def date_range_filter(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Date between ``lo`` and ``hi``, both inclusive."""
    return df.filter(F.col(col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def set_filter(df: DataFrame, col: str, members: Sequence) -> DataFrame:
    """Keep listed members; null is never a member."""
    return df.filter(F.col(col).isin(list(members)))


def review_length(df: DataFrame, text_col: str, out: str = "review_length") -> DataFrame:
    """Text length in characters (code points)."""
    return df.withColumn(out, F.length(text_col))


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by ``order_by`` (then by all other columns).

    Written as an aggregate, ``min(struct(order, rest))`` per key, instead of
    ``row_number()`` over a window: the aggregate keeps one candidate per key
    per task before the shuffle, so a key holding a third of the rows is
    reduced map-side instead of being sorted whole in one task.  It costs a second
    sort, which saves nothing when keys are nearly unique.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def dedup_rows(df: DataFrame) -> DataFrame:
    """All-column dedup."""
    return df.distinct()
