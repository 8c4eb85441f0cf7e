"""Running statistics on a stream (S3/S4): what was seen so far, kept as mergeable moments.

Rows of a micro-batch are judged by the rows of all batches before it.  The state is one row for each key with
(n, mean, m2), the count, mean and sum of squared deviations, which merge without the rows:

    n = n1 + n2, d = mean2 - mean1, mean = mean1 + d * n2 / n, m2 = m2_1 + m2_2 + d^2 * n1 * n2 / n

Every batch writes its flagged rows and the state after it into folders named by its number.  A batch that is run
again after a failure reads the state before it, not its own, and overwrites both folders with the same rows: nothing is
counted twice.  State versions older than the one before are dropped; a batch's cost does not grow with the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MOMENTS = ["n", "mean", "m2"]


def moments(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, n, mean, m2 of the rows with a value (partial aggregates, one row for each key)."""
    v = F.col(f"`{col}`").cast("double")
    found = df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*[f"`{k}`" for k in keys])
    return found.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2")).filter("n > 0")


def merge_moments(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Moments of both inputs' rows together; null keys are a key."""
    a = a.select(*[F.col(f"`{k}`").alias(k) for k in keys], *[F.col(c).alias(f"_1{c}") for c in MOMENTS],
                 *[F.lit(None).cast("double").alias(f"_2{c}") for c in MOMENTS])
    b = b.select(*[F.col(f"`{k}`").alias(k) for k in keys], *[F.lit(None).cast("double").alias(f"_1{c}") for c in MOMENTS],
                 *[F.col(c).alias(f"_2{c}") for c in MOMENTS])
    both = a.unionByName(b).groupBy(*[f"`{k}`" for k in keys]).agg(
        *[F.coalesce(F.max(f"_{i}{c}"), F.lit(0.0)).alias(f"_{i}{c}") for i in (1, 2) for c in MOMENTS])
    n, d = F.col("_1n") + F.col("_2n"), F.col("_2mean") - F.col("_1mean")
    return both.filter(n > 0).select(
        *[f"`{k}`" for k in keys], n.cast("long").alias("n"), (F.col("_1mean") + d * F.col("_2n") / n).alias("mean"),
        (F.col("_1m2") + F.col("_2m2") + d * d * F.col("_1n") * F.col("_2n") / n).alias("m2"))


def flag_by_moments(df: DataFrame, state: DataFrame | None, col: str, threshold: float = 2.0, keys: Sequence[str] = (),
                    out: str = "is_anomaly") -> DataFrame:
    """One-sided z-score flag of ``col`` by the state's mean and sample deviation; false without two values or deviation."""
    if state is None:
        return df.withColumn(out, F.lit(False))
    sd = F.sqrt(F.try_divide(F.col("_m2"), F.col("_n") - 1))
    z = F.try_divide(F.col(f"`{col}`").cast("double") - F.col("_mean"), sd)
    known = state.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_{c}") for c in MOMENTS])
    if keys:
        on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        joined = df.join(known, on, "left")
    else:  # one row: three numbers, as literals
        row = known.first()
        joined = df.withColumns({f"_{c}": F.lit(None if row is None else row[f"_{c}"]).cast("double") for c in MOMENTS})
    return joined.withColumn(out, F.coalesce(z > F.lit(threshold), F.lit(False))).select(*[f"`{c}`" for c in df.columns], out)


class RunningState:
    """Versions of the moments below ``path``: the state after batch b lies in ``path/batch=b``."""

    def __init__(self, spark: SparkSession, path: str, kept: int = 2):
        self.spark, self.path, self.kept = spark, path.rstrip("/"), kept
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Batches whose state was written whole (Spark's _SUCCESS marks it)."""
        top = self._hadoop.Path(self.path)
        if not self._fs.exists(top):
            return []
        found = [s.getPath() for s in self._fs.listStatus(top) if s.getPath().getName().startswith("batch=")]
        return sorted(int(p.getName().removeprefix("batch=")) for p in found if self._fs.exists(self._hadoop.Path(p, "_SUCCESS")))

    def before(self, batch: int) -> DataFrame | None:
        """The last state that no row of this batch or of a later one is in."""
        older = [v for v in self.versions() if v < batch]
        return self.spark.read.parquet(f"{self.path}/batch={older[-1]}") if older else None

    def write(self, batch: int, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        for old in [v for v in self.versions() if v <= batch][:-self.kept]:
            self._fs.delete(self._hadoop.Path(f"{self.path}/batch={old}"), True)


def running_batch(batch_df: DataFrame, batch: int, col: str, sink: str, state: RunningState, threshold: float = 2.0,
                  keys: Sequence[str] = ()) -> None:
    """One micro-batch: flag by the state before it, write the rows, write the state after it.  Running it again
    changes nothing."""
    earlier = state.before(batch)
    (flag_by_moments(batch_df, earlier, col, threshold, keys).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch}"))
    own = moments(batch_df, col, keys)
    state.write(batch, own if earlier is None else merge_moments(earlier, own, keys))


def run_running_zscore(stream: DataFrame, col: str, sink: str, state_path: str, checkpoint: str, threshold: float = 2.0,
                       keys: Sequence[str] = (), processing_time: str | None = None, timeout: float | None = None) -> StreamingQuery:
    """Run a stream with flags by all earlier batches into ``sink`` (Parquet, partitioned by batch).

    Without ``processing_time`` everything present is read and the run ends (``availableNow``); with it, a batch starts
    that often until ``timeout`` seconds have passed (for ever, if None).
    """
    state = RunningState(stream.sparkSession, state_path)

    def one(df: DataFrame, batch: int) -> None:
        running_batch(df, batch, col, sink, state, threshold, keys)

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    q = (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()
    if timeout is None:
        q.awaitTermination()
    finished = timeout is None or q.awaitTermination(timeout)
    if not finished:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
    if not finished and not processing_time:
        raise TimeoutError(f"the stream had more to read after {timeout} s")
    return q
