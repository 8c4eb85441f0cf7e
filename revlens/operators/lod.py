"""Fixed level-of-detail aggregates (BI worksheets) and spike detection.

A FIXED aggregate is computed on the *unfiltered* input at its own
dimensions, before the sheet's dimension filters, and attached to the view
through a join on those dimensions.  Filtering first and aggregating after
would let Catalyst push the filter below the aggregate and change the
numbers, so the two branches are kept apart explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null; the keys of the left side stay."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def fixed_lod(df: DataFrame, fixed_dims: Sequence[str], agg: Column, view_dims: Sequence[Column],
              where: Column | None = None, having: tuple | None = None,
              alias: str = "value") -> DataFrame:
    """AG13: ``SUM({FIXED fixed_dims: agg})`` shown at ``view_dims``.

    ``fixed``: one row per fixed key over all rows.  ``view``: the distinct
    (view dims, fixed dims) combinations that survive ``where``; each fixed
    value is counted once per view mark, not once per underlying row.
    ``having`` = (lo, hi), inclusive, applied to the summed value.
    """
    fixed = df.groupBy(*fixed_dims).agg(agg.alias("_fixed"))
    base = df.filter(where) if where is not None else df
    view = base.select(*view_dims, *fixed_dims).distinct()
    names = [c for c in view.columns if c not in fixed_dims]
    out = (null_safe_join(view, fixed, fixed_dims, "inner")
               .groupBy(*names).agg(F.sum("_fixed").alias(alias)))
    if having is not None:
        lo, hi = having
        if lo is not None:
            out = out.filter(F.col(alias) >= F.lit(lo))
        if hi is not None:
            out = out.filter(F.col(alias) <= F.lit(hi))
    return out


def lod_per_key(df: DataFrame, key: str, agg: Column, alias: str = "value") -> DataFrame:
    """AG14: ``{FIXED key: agg}`` as a table, one row per key."""
    return df.groupBy(key).agg(agg.alias(alias))


#: A key with more than 1 / HOT_KEYS of all rows is hot; there are fewer than HOT_KEYS of them, whatever the input.
HOT_KEYS = 10_000


def lod_join(df: DataFrame, keys: Sequence[str], agg: Column, alias: str = "fixed_value",
             hot_keys: int = HOT_KEYS) -> DataFrame:
    """Attach a fixed-level aggregate to every row.

    Aggregate-then-join rather than ``Window.partitionBy(keys)``: the aggregate
    combines map-side.  Rows of hot keys (null is a key like any other) get
    their value from a short list and are neither shuffled nor sorted, as all
    rows of such a key would land in one task.  The other rows are joined by key.
    """
    rows = F.col("_key_rows")
    fixed = df.groupBy(*keys).agg(agg.alias(alias), F.count(F.lit(1)).alias("_key_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    # the limit is above what their shares of the rows allow: it drops no key and tells the planner how short the list is
    hot = fixed.filter(rows * hot_keys > total).limit(hot_keys).drop("_key_rows")
    rare = fixed.filter(rows * hot_keys <= total).drop("_key_rows")
    return null_safe_join(df, hot, keys, "inner").union(
        null_safe_join(null_safe_join(df, hot, keys, "left_anti"), rare, keys, "left"))


def daily_counts(df: DataFrame, date_col: str, count_col: str | None = None) -> DataFrame:
    cnt = F.count(count_col) if count_col else F.count(F.lit(1))
    return df.groupBy(F.col(date_col).alias("day")).agg(cnt.alias("day_count"))


def spike_days_band(df: DataFrame, date_col: str, lo: int, hi: int, count_col: str | None = None) -> DataFrame:
    """C6 (band form): days whose count lies inside [lo, hi]."""
    d = daily_counts(df, date_col, count_col)
    return d.filter(F.col("day_count").between(lo, hi))


def spike_days_z(df: DataFrame, date_col: str, k: float = 2.0, trailing: int = 28,
                 count_col: str | None = None) -> DataFrame:
    """C6 (z form): flag a day whose count exceeds mean + k·sd of the days with
    reviews among the previous ``trailing`` calendar days.

    No window and no single partition: every day credits its count to each
    of the ``trailing`` days after it (a fixed fan-out of the per-day series),
    mean and sample deviation per target day merge stably (no difference of
    large squares), and they are joined back on the day.
    """
    d = daily_counts(df, date_col, count_col)
    c = F.col("day_count").cast("double")
    targets = F.sequence(F.date_add(F.col("day"), 1), F.date_add(F.col("day"), trailing))
    credits = d.select(F.explode(targets).alias("day"), c.alias("c"))
    sums = credits.groupBy("day").agg(F.avg("c").alias("trailing_mean"), F.stddev_samp("c").alias("trailing_sd"))
    limit = F.col("trailing_mean") + F.lit(k) * F.col("trailing_sd")
    out = d.join(sums, "day", "left")
    return out.select(
        "day", "day_count",
        "trailing_mean",
        "trailing_sd",
        F.coalesce(F.col("day_count") > limit, F.lit(False)).alias("is_spike"))
