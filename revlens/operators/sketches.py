"""A store of daily sketches: distinct customers and quartiles over any range of days without reading the rows again.

One pass over the rows gives, for each day and group, the number of rows, a theta sketch of the counted column and a
KLL sketch of the measured column.  Sketches of days unite into the sketch of any range, and theta sketches of several
ranges intersect into those seen in all of them.  A question reads sketches of its days only (the store is laid
out by day), a few kilobytes each, however many rows the days had.

Errors: a count is off by more than ``count_error`` times the size of the union with a chance below 1 in 300 (three
standard errors; counts below the sketch's size are exact), a rank by more than ``RANK_ERROR`` about as seldom.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: log2 of the entries of a theta sketch; size parameter of a KLL sketch and the rank error (about three standard ones) that it gives.
LOG_ENTRIES, KLL_SIZE, RANK_ERROR = 12, 200, 0.03


def count_error(log_entries: int = LOG_ENTRIES) -> float:
    return 3 / math.sqrt(2 ** log_entries)


def daily_sketches(df: DataFrame, date_col: str, groups: Sequence[str] = (), counted: str | None = None, measured: str | None = None,
                   log_entries: int = LOG_ENTRIES, kll_size: int = KLL_SIZE) -> DataFrame:
    """day, groups, n, and the sketches ``customers`` (of ``counted``) and ``values`` (of ``measured``).  Rows without a day are left out."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if counted:
        aggs.append(F.theta_sketch_agg(F.col(counted), log_entries).alias("customers"))
    if measured:
        aggs.append(F.kll_sketch_agg_double(F.col(measured).cast("double"), kll_size).alias("values"))
    day = F.to_date(date_col)
    return df.filter(day.isNotNull()).groupBy(day.alias("day"), *groups).agg(*aggs)


@dataclass(frozen=True)
class SketchStore:
    """Daily sketches stored at ``path``, laid out by day."""

    spark: SparkSession
    path: str
    log_entries: int = LOG_ENTRIES

    @classmethod
    def write(cls, sketches: DataFrame, path: str, n_files: int = 8, log_entries: int = LOG_ENTRIES) -> SketchStore:
        sketches.repartitionByRange(n_files, "day").sortWithinPartitions("day").write.parquet(path)
        return cls(sketches.sparkSession, path, log_entries)

    def append(self, sketches: DataFrame) -> None:
        """More days, or more rows of the same days: sketches of one day unite like those of several."""
        sketches.coalesce(1).sortWithinPartitions("day").write.mode("append").parquet(self.path)

    def _in_ranges(self, ranges: Mapping[str, tuple[str, str]]) -> DataFrame:
        """The stored rows, once for each range (name -> first and last day) that their day is in."""
        if not ranges:
            raise ValueError("no range")
        stored = self.spark.read.parquet(self.path)
        first, last = min(a for a, _ in ranges.values()), max(b for _, b in ranges.values())
        known = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b"))
                          for n, (a, b) in ranges.items()])
        hit = F.filter(known, lambda r: (r["a"] <= F.col("day")) & (F.col("day") <= r["b"]))
        return (stored.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
                .withColumn("range", F.explode(F.transform(hit, lambda r: r["name"]))))

    def distinct(self, ranges: Mapping[str, tuple[str, str]], groups: Sequence[str] = ()) -> DataFrame:
        """range, groups, estimate, error: different customers of each range, and how far the estimate may be off."""
        united = self._in_ranges(ranges).groupBy("range", *groups).agg(F.theta_union_agg("customers", self.log_entries).alias("s"))
        return united.select("range", *groups, F.theta_sketch_estimate("s").alias("estimate"), self._error(F.theta_sketch_estimate("s")))

    def in_all(self, sets: Mapping[str, Sequence[tuple[str, str]]], groups: Sequence[str] = ()) -> DataFrame:
        """name, groups, estimate, error: customers seen in every range of a set of ranges."""
        ranges = {f"{name}\0{k}": r for name, own in sets.items() for k, r in enumerate(own)}
        united = self._in_ranges(ranges).groupBy("range", *groups).agg(F.theta_union_agg("customers", self.log_entries).alias("s"))
        size = F.element_at(F.create_map(*[x for n, own in sets.items() for x in (F.lit(n), F.lit(len(own)))]), F.col("name"))
        found = (united.withColumn("name", F.split_part("range", F.lit("\0"), F.lit(1))).groupBy("name", *groups)
                 .agg(F.theta_intersection_agg("s").alias("both"), F.theta_union_agg("s", self.log_entries).alias("any"), F.count("*").alias("k")))
        met = F.when(F.col("k") == size, F.theta_sketch_estimate("both")).otherwise(0)  # a range without rows meets nobody
        return found.select("name", *groups, met.alias("estimate"), self._error(F.theta_sketch_estimate("any")))

    def quantiles(self, ranges: Mapping[str, tuple[str, str]], shares: Sequence[float] = (0.25, 0.5, 0.75), groups: Sequence[str] = ()) -> DataFrame:
        """range, groups, share, value: the value at each share of the ordered values."""
        merged = self._in_ranges(ranges).groupBy("range", *groups).agg(F.kll_merge_agg_double("values").alias("s"))
        at = F.array(*[F.lit(float(p)) for p in shares])
        cells = F.arrays_zip(at.alias("share"), F.kll_sketch_get_quantile_double("s", at).alias("value"))
        return merged.filter(F.kll_sketch_get_n_double("s") > 0).select("range", *groups, F.inline(cells))

    def _error(self, size: Column) -> Column:
        exact = size < 2 ** (self.log_entries - 1)  # a sketch that is not full holds every value
        return F.when(exact, F.lit(0.0)).otherwise(count_error(self.log_entries) * size).alias("error")
