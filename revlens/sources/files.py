"""File sources and sinks: JSON lines, JSON arrays, parquet, partitioned parquet, exports.

Readers always take an explicit schema (no inference pass over the data);
writers never funnel a large table through one task.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_review_time

CORRUPT = "_corrupt_record"

# Timestamps travel through JSON with microseconds (the writer's default keeps
# milliseconds only).
JSON_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Review rows as they are stored in the JSON dumps.  Ratings arrive as 3.0,
# flags as "false" or true and votes as "1,234", so the raw schema keeps
# them loose and ``normalize_reviews`` types them.
REVIEW_RAW_SCHEMA = T.StructType([
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("reviewerName", T.StringType()),
    T.StructField("reviewText", T.StringType()),
    T.StructField("overall", T.DoubleType()),
    T.StructField("summary", T.StringType()),
    T.StructField("unixReviewTime", T.LongType()),
    T.StructField("verified", T.StringType()),
    T.StructField("vote", T.StringType()),
    T.StructField("reviewTime", T.StringType()),
])

# The older dumps have ``helpful`` ("[2, 3]": helpful votes, all votes) and neither ``verified`` nor ``vote``.
REVIEW_V0_SCHEMA = T.StructType(
    [f for f in REVIEW_RAW_SCHEMA.fields if f.name not in ("verified", "vote")] + [T.StructField("helpful", T.StringType())])

# Pragma-label rows (ID, realId, pragma and seven 0/1 labels).
PRAGMA_LABELS = ("label_para", "label_function_call", "label_nested_loop", "label_reduction",
                 "label_task", "label_simd", "label_target")
BONUS_SCHEMA = T.StructType(
    [T.StructField("ID", T.StringType()), T.StructField("realId", T.StringType()),
     T.StructField("pragma", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in PRAGMA_LABELS])


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT) -> T.StructType:
    if name in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(name, T.StringType())])


def scan_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
              keep_corrupt: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON lines (gzip or plain) with an explicit schema.

    PERMISSIVE: a malformed line becomes a row of nulls whose raw text is kept
    in ``_corrupt_record``.
    """
    sch = with_corrupt_column(schema) if keep_corrupt else schema
    reader = spark.read.schema(sch).option("mode", mode).options(**JSON_TS_OPTIONS)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """JSON lines writer matching ``scan_json`` (microsecond timestamps)."""
    w = df.write.mode(mode).options(**JSON_TS_OPTIONS)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def normalize_reviews(df: DataFrame) -> DataFrame:
    """Type the loose review fields: rating -> int, flag -> boolean, votes ->
    int (null when not a plain number, e.g. '1,234'), reviewTime -> date,
    helpful "[2, 3]" -> helpful_votes and all_votes (null when it has another form)."""
    cols = []
    for c in df.columns:
        if c == "overall":
            cols.append(F.col(c).cast("int").alias(c))
        elif c == "verified":
            cols.append(F.col(c).cast("string").try_cast("boolean").alias(c))
        elif c == "vote":
            cols.append(F.col(c).try_cast("int").alias(c))
        elif c == "helpful":
            cols.append(F.col(c))
            cols += [F.regexp_extract(c, r"^\s*\[\s*(\d+)\s*,\s*(\d+)\s*\]\s*$", i).try_cast("int").alias(name)
                     for i, name in ((1, "helpful_votes"), (2, "all_votes"))]
        elif c == "reviewTime":
            cols.append(F.col(c))
            cols.append(parse_review_time(c).alias("review_date"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def label_counts(df: DataFrame, labels: Sequence[str] = PRAGMA_LABELS) -> DataFrame:
    """Rows that carry each 0/1 label, long form (label, rows), in one pass."""
    wide = df.agg(*[F.count_if(F.col(c) == 1).alias(c) for c in labels])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("rows")) for c in labels])))


def load_counted(spark: SparkSession, path, schema: T.StructType) -> tuple[DataFrame, int, float]:
    """Load, count and time.  Raises on failure instead of returning None."""
    t0 = time.time()
    df = scan_json(spark, path, schema)
    n = df.count()
    return df, n, time.time() - t0


def count_frame(df: DataFrame) -> DataFrame:
    """I2 as a DataFrame: the record count of a loaded source."""
    return df.agg(F.count(F.lit(1)).alias("n_records"))


def scan_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """Parquet scan; the projection and the filter reach the reader
    (ReadSchema / PushedFilters) because they are declared on the scan."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    """I4: write a table as parquet (every task writes its own files)."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str] = "overall", mode: str = "overwrite",
                      max_records_per_file: int | None = 5_000_000) -> None:
    """Hive-style partitioned parquet (``by=value`` folders).

    No ``repartition(by)`` first: with a 5-value key that would put a fifth
    of the table in one task.  Each task writes one file per value it holds,
    capped by ``maxRecordsPerFile``.
    """
    cols = [by] if isinstance(by, str) else list(by)
    w = df.write.mode(mode).partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def table_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Stored bytes and file count of a parquet table, one row read for each file
    (the content column is pruned; works on any filesystem Spark can read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    return files.agg(F.sum("length").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files"))


def write_json_arrays(df: DataFrame, path: str, n_files: int | None = None, rows_per_file: int = 100_000) -> None:
    """Write rows as JSON-array documents (one array per file).

    Rows are dealt round-robin by their position (not by content, so a
    heavily repeated row cannot pile into one file).  The number of files
    follows from the row count (one pass more), so an array stays at about
    ``rows_per_file`` rows however large the table is; ``n_files`` fixes it.
    """
    if n_files is None:
        n_files = max(1, -(-df.count() // rows_per_file))
    b = F.pmod(F.monotonically_increasing_id(), F.lit(n_files))
    docs = (df.select(b.alias("bucket"), F.to_json(F.struct(*df.columns)).alias("_j"))
              .groupBy("bucket")
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list("_j"), ","), F.lit("]")).alias("value")))
    docs.write.mode("overwrite").partitionBy("bucket").text(path)


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    check: bool = True) -> DataFrame:
    """Multi-line JSON arrays of flat objects.

    ``check`` rejects input that is empty or whose elements are not objects
    (they land in ``_corrupt_record``); it runs a ``limit(1)`` probe, not a
    full pass.
    """
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.json(path)
    if check:
        if df.isEmpty():
            raise ValueError(f"{path}: no rows (expected a non-empty array of objects)")
        data_cols = [c for c in df.columns if c != CORRUPT]
        # Spark refuses a raw-JSON query that reads only the corrupt column,
        # so the probe carries one data column along.
        if CORRUPT in df.columns and data_cols and (
                df.filter(F.col(CORRUPT).isNotNull()).select(data_cols[0], CORRUPT).first() is not None):
            raise ValueError(f"{path}: contains elements that are not flat objects")
    return df.drop(CORRUPT) if CORRUPT in df.columns else df


def export_summary(df: DataFrame, path: str, fmt: str = "json", single_file: bool = False) -> None:
    """Write a chart-ready aggregate (a few rows per chart) as JSON or CSV.

    ``single_file`` coalesces to one part file: for aggregates of a fixed size only.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
