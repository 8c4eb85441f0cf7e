"""Joins: relating extracts, brushing and linking between charts.

A selection is either a short literal list (what a user clicks) or a
DataFrame of keys.  Lists become ``isin`` predicates; DataFrames become
left-semi joins, which Spark broadcasts only when the planner measures the
selection as small and otherwise runs as a shuffled semi join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relate(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of two extracts on a shared key (inner or left)."""
    if how not in ("inner", "left"):
        raise ValueError("relate supports inner and left joins")
    return left.join(right, key if isinstance(key, str) else list(key), how)


def _as_str(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def brush_rows(df: DataFrame, key: str, selection) -> DataFrame:
    """Rows whose key (string form) is in the selection."""
    if isinstance(selection, DataFrame):
        sel = selection.select(F.col(selection.columns[0]).cast("string").alias("_sel")).distinct()
        return df.join(sel, _as_str(key) == sel["_sel"], "left_semi")
    return df.filter(_as_str(key).isin([str(v) for v in selection]))


def brush_multi_key(df: DataFrame, keys: Sequence[str], selection, mode: str = "any") -> DataFrame:
    """Selection over several key columns.

    ``mode="any"``: a row matches when any key is selected (chord: either
    end).  ``mode="path"``: ``selection`` is a list of paths (tuples); a row
    matches when its leading key values equal one of them (sunburst: rows
    under the selected arc).
    """
    if mode == "any":
        sel = [str(v) for v in selection]
        cond = F.lit(False)
        for k in keys:
            cond = cond | _as_str(k).isin(sel)
        return df.filter(cond)
    if mode == "path":
        cond = F.lit(False)
        for path in selection:
            part = F.lit(True)
            for k, v in zip(keys, path):
                part = part & (_as_str(k) == F.lit(str(v)))
            cond = cond | part
        return df.filter(cond)
    raise ValueError(mode)


def brush_highlight(df: DataFrame, selected_rows_key: str, selection,
                    roles: Mapping[str, Sequence[str]], source_chart: str | None = None) -> DataFrame:
    """For every other chart, the distinct values it must highlight.

    ``roles`` maps chart name -> the columns whose values that chart shows
    (radial: category; chord: source and target; force: node id and link
    target; sunburst: first hierarchy level).  Output: (chart, value).
    """
    rows = brush_rows(df, selected_rows_key, selection)
    cells = [F.struct(F.lit(chart).alias("chart"), F.col(c).cast("string").alias("value"))
             for chart, cols in roles.items() if chart != source_chart for c in cols]
    if not cells:
        raise ValueError("no target chart")
    # one scan of the selected rows: every (chart, value) pair comes out of one generator
    out = rows.select(F.inline(F.array(*cells)))
    return out.filter(F.col("value").isNotNull()).distinct()
