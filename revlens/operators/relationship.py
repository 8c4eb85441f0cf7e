"""J1 as a relationship: two tables that stay apart, measures at the grain of their own table.

A join of two tables with many rows a key multiplies them, and sums over it count rows several times.
A relationship names only the tables and their key.  Each question then decides what is read:

- a measure is aggregated over its own table, at the grain of (key, its own dimensions), before anything is joined;
- a dimension of the other table reaches it through the distinct (key, dimension values) of that table, so a
  row counts once for each value that it is related to, however many rows carry it;
- a table that gives no measure, no dimension and no filter is not read.

The partial results of both tables are put under one another and merged by dimension, so no rows are
matched twice.  What crosses a shuffle is one row for each task, key and combination of dimension values: a key
that holds a third of the rows travels as a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("left", "right")
KINDS = ("rows", "count", "sum", "avg", "min", "max", "distinct")


@dataclass(frozen=True)
class Measure:
    """An aggregate over one table: ``kind`` of ``column`` (``rows`` needs none)."""

    side: str
    kind: str
    column: str | None = None

    def __post_init__(self):
        if self.side not in SIDES or self.kind not in KINDS or (self.column is None) != (self.kind == "rows"):
            raise ValueError(f"no such measure: {self}")


@dataclass(frozen=True)
class Relationship:
    """Two tables related by ``keys`` (pairs of a left and a right column; a name stands for both).

    ``matched`` keeps related rows only; else a row without a partner has null in the other table's dimensions.  A null key
    has no partner.
    """

    left: DataFrame
    right: DataFrame
    keys: Sequence[str | tuple[str, str]]
    matched: bool = False
    _names: tuple[list[str], list[str]] = field(init=False, default=((), ()))

    def __post_init__(self):
        pairs = [(k, k) if isinstance(k, str) else k for k in self.keys]
        if not pairs:
            raise ValueError("a relationship needs a key")
        object.__setattr__(self, "_names", tuple(list(x) for x in zip(*pairs)))

    def _frame(self, side: str) -> tuple[DataFrame, list[str]]:
        at = SIDES.index(side)
        return (self.left, self.right)[at], self._names[at]

    def _keyed(self, side: str, where: Mapping[str, Column], dims: list[str], values: Sequence[str] = ()) -> DataFrame:
        """The side's filtered rows: keys as _k0.., its dimensions as _d.., value columns as _v..."""
        df, keys = self._frame(side)
        if side in where:
            df = df.filter(where[side])
        return df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[F.col(f"`{d}`").alias(f"_d_{d}") for d in dims], *[F.col(f"`{v}`").alias(f"_v_{v}") for v in dict.fromkeys(values)])

    def _reached(self, own: DataFrame, other: str, where: Mapping[str, Column], dims: list[str]) -> DataFrame:
        """``own`` (one row for each key and combination) with the other side's dimensions."""
        if not dims and other not in where and not self.matched:
            return own
        k = [f"_k{i}" for i in range(len(self.keys))]
        bridge = self._keyed(other, where, dims).dropna(subset=k).distinct()
        # a filter on the other table leaves only rows that are related to what it keeps
        return own.join(bridge, k, "inner" if self.matched or other in where else "left")

    def measures(self, dims: Sequence[tuple[str, str]], measures: Mapping[str, Measure],
                 where: Mapping[str, Column] | None = None) -> DataFrame:
        """One row for each combination of ``dims`` (side, column) that a row of a measured table has: the dimensions by
        their column names, then the measures.  A measure without rows is null.  ``where`` (side -> condition) filters
        a table; the other's rows then count only if they are related to a row that stays."""
        where = dict(where or {})
        if not measures or any(s not in SIDES for s, _ in dims) or any(s not in SIDES for s in where):
            raise ValueError("measures, and sides left or right, are needed")
        names = [d for _, d in dims]
        if len(set(names) | set(measures)) < len(names) + len(measures):
            raise ValueError("dimensions and measures need different names")
        parts = []
        for side in SIDES:
            asked = {n: m for n, m in measures.items() if m.side == side}
            plain = {n: m for n, m in asked.items() if m.kind != "distinct"}
            if plain:
                parts.append(self._plain(side, dims, plain, where))
            for n, m in asked.items():
                if m.kind == "distinct":
                    parts.append(self._distinct(side, dims, n, m, where))
        whole = None
        for p in parts:  # each measure comes from one part
            p = p.select(*names, *[F.col(n) if n in p.columns else F.lit(None).alias(n) for n in measures])
            whole = p if whole is None else whole.unionByName(p)
        if len(parts) == 1:
            return whole
        return whole.groupBy(*names).agg(*[F.max(n).alias(n) for n in measures])

    def _split(self, side: str, dims: Sequence[tuple[str, str]]) -> tuple[str, list[str], list[str]]:
        other = SIDES[1 - SIDES.index(side)]
        return other, [d for s, d in dims if s == side], [d for s, d in dims if s == other]

    def _plain(self, side: str, dims: Sequence[tuple[str, str]], asked: Mapping[str, Measure], where: Mapping[str, Column]) -> DataFrame:
        other, own_dims, other_dims = self._split(side, dims)
        rows = self._keyed(side, where, own_dims, [m.column for m in asked.values() if m.column])
        kept = [f"_k{i}" for i in range(len(self.keys))] + [f"_d_{d}" for d in own_dims]
        partial, final = [], []
        for n, m in asked.items():
            v = F.lit(1) if m.kind == "rows" else F.col(f"`_v_{m.column}`")
            if m.kind in ("rows", "count"):
                partial.append(F.count(v).alias(f"_p_{n}"))
                final.append(F.sum(f"`_p_{n}`").alias(n))
            elif m.kind == "avg":
                partial += [F.sum(v).alias(f"_s_{n}"), F.count(v).alias(f"_p_{n}")]
                final.append(F.try_divide(F.sum(f"`_s_{n}`"), F.sum(f"`_p_{n}`")).alias(n))
            else:
                fn = {"sum": F.sum, "min": F.min, "max": F.max}[m.kind]
                partial.append(fn(v).alias(f"_p_{n}"))
                final.append(fn(f"`_p_{n}`").alias(n))
        grain = rows.groupBy(*[f"`{c}`" for c in kept]).agg(*partial)
        reached = self._reached(grain, other, where, other_dims)
        return reached.groupBy(*[F.col(f"`_d_{d}`").alias(d) for _, d in dims]).agg(*final)

    def _distinct(self, side: str, dims: Sequence[tuple[str, str]], name: str, m: Measure, where: Mapping[str, Column]) -> DataFrame:
        other, own_dims, other_dims = self._split(side, dims)
        values = self._keyed(side, where, own_dims, [m.column]).distinct()
        reached = self._reached(values, other, where, other_dims)
        return (reached.groupBy(*[F.col(f"`_d_{d}`").alias(d) for _, d in dims])
                .agg(F.countDistinct(F.col(f"`_v_{m.column}`")).alias(name)))
