"""Structured Streaming: file sources, cleaning, dedup with bounded state, z-score, runs.

Global statistics cannot be computed on an unbounded stream, so the z-score
is *fitted* on static history (two numbers) and *applied* to the stream as
literals.  Dedup with a watermark keeps state bounded; the plain form keeps
every key forever and is only offered for bounded inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import drop_missing


def stream_json(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """I8: JSON-lines file stream with an explicit schema."""
    from ..sources.files import JSON_TS_OPTIONS
    r = spark.readStream.schema(schema).options(**JSON_TS_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Parquet file stream; ``file_glob`` keeps only matching file names of the folder
    (e.g. one table's file among several)."""
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def stream_table(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet table as a stream, whether it is stored as a folder of part files
    or as one file (then its folder is streamed, that file name only)."""
    static = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = static.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}"):
        return stream_parquet(spark, folder, static.schema, max_files_per_trigger, file_glob=name)
    return stream_parquet(spark, path, static.schema, max_files_per_trigger)


def event_time(df: DataFrame, col: str, out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); with the session in UTC the
    wall-clock value is unchanged."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def stream_dedup(df: DataFrame, keys: Sequence[str], time_col: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """Drop repeated keys.

    With ``time_col`` and ``delay`` the state is bounded: a key is remembered
    until the watermark passes it (``dropDuplicatesWithinWatermark``).  Without
    them every key stays in state for the life of the query.
    """
    if time_col and delay:
        return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def stream_clean(df: DataFrame, keys: Sequence[str], required: Sequence[str],
                 time_col: str | None = None, delay: str | None = None) -> DataFrame:
    """Dedup on ``keys`` then drop rows missing any ``required`` column."""
    return drop_missing(stream_dedup(df, keys, time_col, delay), required)


def fit_zscore(static_df: DataFrame, col: str) -> dict[str, float | None]:
    """Fit mean and sample stddev on static history (one aggregate, one row back)."""
    row = static_df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd")).first()
    return {"mean": row["mean"], "sd": row["sd"]}


def stream_zscore(df: DataFrame, col: str, fit: dict[str, float | None], threshold: float = 2.0,
                  out: str = "is_anomaly") -> DataFrame:
    """S3: one-sided z-score flag on a stream using fitted statistics."""
    mean = F.lit(fit["mean"]).cast("double")
    sd = F.lit(fit["sd"]).cast("double")
    z: Column = F.try_divide(F.col(col) - mean, sd)
    return df.withColumn(out, F.coalesce(z > F.lit(threshold), F.lit(False)))


def stream_run(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
               processing_time: str | None = None, timeout: float | None = None,
               output_mode: str = "append") -> StreamingQuery:
    """Run a stream into a file sink with a checkpoint.

    ``processing_time=None`` uses ``availableNow``: everything present is
    processed (possibly in several micro-batches) and the query stops; it waits
    as long as that takes, and a ``timeout`` (seconds) that it does not meet
    raises, so a caller never reads part of a sink unnoticed.  A
    processing-time trigger has no end of its own: it is stopped after
    ``timeout`` seconds (never, if None).
    """
    w = (df.writeStream.format(fmt).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).option("path", sink_path))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
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
