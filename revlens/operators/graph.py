"""Flows, edge lists and hierarchies shaped from flat rows (chart inputs).

Everything stays in sparse long form: a flow "matrix" is (source, target,
value) rows produced by a hash aggregate, a hierarchy is one row per tree
node from ``rollup``.  Nothing is densified n x n and no tree is built on
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import coerce_numeric


def _present(c: Column) -> Column:
    """Truthiness of a level / edge end: null and the empty string are absent."""
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def category_sum(df: DataFrame, category: str, value: str) -> DataFrame:
    """AG24: sum of a numeric value per category, largest first.

    Non-numeric values are skipped (prefix parse of strings); a null category
    is a group of its own.
    """
    v = coerce_numeric(value, dict(df.dtypes).get(value))
    agg = df.groupBy(F.col(category).alias("category")).agg(F.sum(v).alias("value"))
    return agg.orderBy(F.col("value").desc_nulls_last(), F.col("category").asc_nulls_first())


def max_domain(agg: DataFrame, value: str = "value") -> DataFrame:
    """AG28: maximum of an aggregated measure (the radial scale domain)."""
    return agg.agg(F.max(value).alias("max_value"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AG29: distinct values of one column."""
    return df.select(col).distinct()


def flow_matrix(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """AG25: directed source->target sums of positive values (sparse matrix cells).

    Null or non-positive values are dropped before the sum, self-flows stay
    on the diagonal.
    """
    v = coerce_numeric(value, dict(df.dtypes).get(value))
    return (df.select(F.col(source).alias("source"), F.col(target).alias("target"), v.alias("_v"))
              .filter(F.col("_v") > 0)
              .groupBy("source", "target").agg(F.sum("_v").alias("value")))


def _both_ends(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Both edge ends as one column, in a single scan (explode of a 2-array)."""
    return df.select(F.explode(F.array(F.col(a), F.col(b))).alias(name))


def union_entities(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Distinct union of both ends, sorted (the matrix row / column order)."""
    return _both_ends(df, source, target, "entity").distinct().orderBy(F.col("entity").asc_nulls_last())


def flow_totals(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """AG26: outgoing total per entity (matrix row sums); target-only entities get 0."""
    cells = flow_matrix(df, source, target, value)
    # one pass over the cells: each cell credits its source and names its target with 0
    ends = cells.select(F.inline(F.array(
        F.struct(F.col("source").alias("entity"), F.col("value").alias("v")),
        F.struct(F.col("target").alias("entity"), F.lit(0.0).alias("v")))))
    return ends.groupBy("entity").agg(F.sum("v").alias("total"))


def union_nodes(df: DataFrame, a: str, b: str) -> DataFrame:
    """D3: distinct node ids from both edge ends, as strings, nulls skipped."""
    ends = df.select(F.explode(F.array(F.col(a).cast("string"), F.col(b).cast("string"))).alias("id"))
    return ends.filter(F.col("id").isNotNull()).distinct()


def edge_list(df: DataFrame, a: str, b: str, value: str | None = None) -> DataFrame:
    """G1: one link per row whose two ends are present and different.

    Ends are compared before the string cast; the link value is the value
    column when it is present and non-zero, else 1.
    """
    ok = _present(F.col(a)) & _present(F.col(b)) & (F.col(a) != F.col(b))
    if value is None:
        v = F.lit(1.0)
    else:
        raw = coerce_numeric(value, dict(df.dtypes).get(value))
        v = F.when(raw.isNull() | F.isnan(raw) | (raw == 0), F.lit(1.0)).otherwise(raw)
    return df.filter(ok).select(F.col(a).cast("string").alias("source"),
                                F.col(b).cast("string").alias("target"), v.alias("value"))


def neighbors(edges: DataFrame, node: str, source: str = "source", target: str = "target") -> DataFrame:
    """Nodes one hop from ``node`` in either direction."""
    s, t, n = F.col(source), F.col(target), F.lit(node)
    touching = edges.filter((s == n) | (t == n))
    # one scan; a self-loop end counts the node itself, as either direction would
    other = F.explode(F.array(F.when(s == n, t), F.when(t == n, s)))
    return touching.select(other.alias("id")).filter(F.col("id").isNotNull()).distinct()


def incident_links(edges: DataFrame, selection: Sequence[str], source: str = "source",
                   target: str = "target") -> DataFrame:
    """Links with at least one end in the selection."""
    sel = list(selection)
    return edges.filter(F.col(source).isin(sel) | F.col(target).isin(sel))


def level_path(levels: Sequence[str]) -> Column:
    """Present levels as a gap-free array: a missing level is skipped and the
    levels below it move one step up."""
    arr = F.array(*[F.when(_present(F.col(c)), F.col(c).cast("string")) for c in levels])
    return F.filter(arr, lambda x: x.isNotNull())


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """AG27: sum of ``value`` at every path prefix (one row per tree node).

    ``depth`` 0 is the root.  Values are true sums (each row counted once per
    ancestor).  ``rollup`` expands each row to its prefixes *before* the
    partial aggregate, so the shuffle carries one row per node per task.
    Groups that only exist because a shorter path has nothing at that depth
    are removed.
    """
    n = len(levels)
    names = [f"level_{i + 1}" for i in range(n)]
    raw = coerce_numeric(value, dict(df.dtypes).get(value))
    v = F.when(raw.isNull() | F.isnan(raw), F.lit(0.0)).otherwise(raw)
    path = level_path(levels)
    base = df.select(*[F.try_element_at(path, F.lit(i + 1)).alias(nm) for i, nm in enumerate(names)],
                     v.alias("_v"))
    depth = sum((F.lit(1) - F.grouping(nm) for nm in names), F.lit(0))
    rolled = base.rollup(*names).agg(F.sum("_v").alias("value"), depth.cast("int").alias("depth"))
    real = F.lit(False)
    for i, nm in enumerate(names):
        real = real | ((F.col("depth") == i + 1) & F.col(nm).isNotNull())
    return rolled.filter((F.col("depth") == 0) | real)


def path_labels(nodes: DataFrame, levels: Sequence[str], root: str = "root",
                sep: str = " > ", id_sep: str = "--") -> DataFrame:
    """Readable label 'A > B > C' and element id 'root--A--B--C' (the whole path) for each node."""
    arr = F.filter(F.array(*[F.col(c).cast("string") for c in levels]), lambda x: x.isNotNull())
    full = F.concat(F.array(F.lit(root)), arr)
    return nodes.select("*", F.array_join(arr, sep).alias("label"),
                        F.array_join(full, id_sep).alias("node_id"))


def leaf_members(df: DataFrame, levels: Sequence[str], prefix: Sequence[str]) -> DataFrame:
    """Distinct leaf names under the node addressed by ``prefix``."""
    path = level_path(levels)
    want = F.array(*[F.lit(str(p)) for p in prefix])
    under = df.select(path.alias("_p")).filter(
        (F.size("_p") >= len(prefix)) & (F.slice("_p", 1, max(len(prefix), 1)) == want)
        if prefix else F.size("_p") > 0)
    return under.select(F.element_at("_p", -1).alias("leaf")).distinct()
