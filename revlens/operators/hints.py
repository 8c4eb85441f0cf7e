"""Physical hints a user can ask for explicitly (rows in = rows out)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cache(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """H1: keep a frame that several actions reuse (spills to disk when memory is short)."""
    return df.persist(level)


def repartition_by(df: DataFrame, n: int | None, *cols: str, n_salts: int = 1) -> DataFrame:
    """H2: hash-partition by columns.

    On a low-cardinality key (a 5-value rating) at most that many partitions
    get data, and a hot key fills one task.  ``n_salts`` deals the rows of each
    key over so many hash buckets (by a hash of the row, so a task that is run
    again deals them alike); equal rows share a bucket.
    """
    keys = [F.col(c) for c in cols]
    if n_salts > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(n_salts)))
    return df.repartition(n, *keys) if n else df.repartition(*keys)


#: Below so many stored bytes for each core an input is dealt out by ``spread_small``.
SPREAD_BYTES = 16 << 20


def spread_small(df: DataFrame, bytes_per_core: int = SPREAD_BYTES) -> DataFrame:
    """H2 for inputs with fewer row groups than cores: deal the rows round robin over all cores, same rows.

    A small file is often one row group, which one task reads; per-row work that costs more than reading (tokenising) then
    leaves all other cores idle.  The size is the planner's estimate from the files, so nothing is read, and an input above
    ``bytes_per_core`` for each core is left as it is: its splits feed the cores, and its rows are never shuffled.
    """
    if not hasattr(df, "_jdf"):  # a Spark Connect session does not tell the size
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < bytes_per_core * cores else df
