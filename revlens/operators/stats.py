"""Correlations, z-scores and scalar statistics attached to rows.

Global statistics are attached as scalar subqueries (``DataFrame.scalar()``):
Spark runs the one-row aggregate once, with map-side partial aggregation,
and inlines the result into the row-level plan.  Nothing goes through the
driver and there is no cartesian product.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import helpful_ratio as _helpful_ratio


def corr_pair(df: DataFrame, x: str, y: str, alias: str = "correlation") -> DataFrame:
    """Pearson correlation of two columns (pairs with a null are skipped)."""
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(alias))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every pair's Pearson r in one pass, returned long-form (x, y, r).

    Both (a, b) and (b, a) are listed, the diagonal included, like a heatmap.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"c{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


def global_stats(df: DataFrame, col: str) -> dict[str, Column]:
    """Mean and sample stddev of a column, from one scalar subquery returning a struct."""
    s = df.agg(F.struct(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))).scalar()
    return {"mean": s.getField("mean"), "sd": s.getField("sd")}


def scalar_broadcast(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach every column of a one-row ``stats`` frame to each row of ``df``
    (one scalar subquery carrying the whole row as a struct)."""
    row = stats.select(F.struct(*[F.col(c) for c in stats.columns])).scalar()
    return df.select("*", *[row.getField(c).alias(c) for c in stats.columns])


def zscore(col: str, stats: dict[str, Column]) -> Column:
    return F.try_divide(F.col(col) - stats["mean"], stats["sd"])


def zscore_flag(df: DataFrame, col: str = "overall", threshold: float = 2.0,
                stats: dict[str, Column] | None = None, out: str = "is_anomaly") -> DataFrame:
    """C4: one-sided z-score flag, ``(x - mean) / sd > threshold``.

    Null value or zero spread gives ``False``.  ``stats`` lets a caller fit on
    other data (the stream case fits on static history).
    """
    st = stats or global_stats(df, col)
    return df.withColumn(out, F.coalesce(zscore(col, st) > F.lit(threshold), F.lit(False)))


def helpful_ratio(df: DataFrame, helpful: str = "helpful", votes: str = "votes",
                  out: str = "helpful_ratio") -> DataFrame:
    """Helpful / votes when votes > 0, else null."""
    return df.withColumn(out, _helpful_ratio(helpful, votes))
