"""Column profiling, shape and data-quality summaries.

``profile_columns`` turns every row into (column, value) pairs with one
generator pass, deduplicates the pairs with a map-side-combined aggregate,
and then summarises per column.  Value lists are only gathered for columns
whose distinct count is below the limit, so no task ever holds the distinct
values of a high-cardinality column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import NUMERIC_PREFIX, numeric_prefix

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC_TYPES):
        return "number"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    return "text"


def _cell(name: str, dt: T.DataType) -> Column:
    """(column, string form, present, numeric-ok, numeric value) for one cell."""
    c = F.col(f"`{name}`")
    s = c.cast("string")
    kind = _kind(dt)
    present = c.isNotNull() & (s != F.lit("")) if kind == "text" else c.isNotNull()
    if kind == "number":
        # a NaN is still a number for the type test, but stays out of min / max
        num = F.when(~F.isnan(c.cast("double")), c.cast("double"))
        ok = F.lit(True)
    elif kind == "boolean":
        num = F.lit(None).cast("double")
        ok = F.lit(False)
    else:
        num = numeric_prefix(s)
        ok = s.rlike(NUMERIC_PREFIX) & ~F.isnan(num) & (F.abs(num) != F.lit(float("inf")))
    return F.struct(F.lit(name).alias("column_name"),
                    F.coalesce(s, F.lit("null")).alias("value"),
                    present.alias("present"), ok.alias("ok"),
                    F.when(present & ok, num).alias("num"))


def _cells(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.select(F.inline(F.array(*[_cell(c, fields[c]) for c in (columns or df.columns)])))


def _summary() -> list[Column]:
    return [F.bool_or("present").alias("present"), F.bool_and(F.when(F.col("present"), F.col("ok"))).alias("ok"),
            F.min("num").alias("min"), F.max("num").alias("max")]


def _typed(per_col: DataFrame, *carry: str) -> DataFrame:
    is_num = F.coalesce(F.col("present"), F.lit(False)) & F.coalesce(F.col("ok"), F.lit(True))
    return per_col.select(
        "column_name",
        F.when(is_num, F.lit("numeric")).otherwise(F.lit("categorical")).alias("type"),
        *carry,
        F.when(is_num, F.col("min")).alias("min"),
        F.when(is_num, F.col("max")).alias("max"))


def _pairs(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Distinct (column, value) pairs with what the summary needs of each."""
    return _cells(df, columns).groupBy("column_name", "value").agg(*_summary())


def profile_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct values of every column, one row each (string form, null
    written 'null'); never gathered into a list, so any column may have any number."""
    return _pairs(df, columns).select("column_name", "value")


def profile_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type and numeric min / max per column without the values: each task sends one row per column."""
    return _typed(_cells(df, columns).groupBy("column_name").agg(*_summary()))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column its type ('numeric' / 'categorical'), distinct count and
    numeric min / max (the values themselves: ``profile_values``).

    A column is numeric when it has at least one present value and every
    present value is a number or a string that starts with one.  The exact
    distinct count shuffles the distinct values; ``profile_types`` does not.
    """
    per_col = (_pairs(df, columns).groupBy("column_name")
                    .agg(F.count(F.lit(1)).alias("n_distinct"), F.bool_or("present").alias("present"),
                         F.bool_and("ok").alias("ok"), F.min("min").alias("min"), F.max("max").alias("max")))
    return _typed(per_col, "n_distinct")


def compatible_dims(profile: DataFrame, kind: str) -> DataFrame:
    """Columns of the requested type ('numeric' or 'categorical') for a chart role
    (of ``profile_types`` or ``profile_columns``)."""
    return profile.filter(F.col("type") == F.lit(kind)).select("column_name")


def filter_widgets(profile: DataFrame, max_values: int = 1000, steps: int = 100) -> DataFrame:
    """Filter spec per column: a range slider for numeric columns, an option
    list for categorical columns with 0 < distinct < ``max_values``, else 'none'
    (the column stays, with its number of values)."""
    rng = (F.col("type") == "numeric") & F.col("min").isNotNull() & F.col("max").isNotNull()
    lst = (F.col("type") == "categorical") & (F.col("n_distinct") > 0) & (F.col("n_distinct") < max_values)
    return (profile
            .withColumn("widget", F.when(rng, F.lit("range")).when(lst, F.lit("list")).otherwise(F.lit("none")))
            .select("column_name", "widget",
                    F.when(rng, F.col("min")).alias("min"), F.when(rng, F.col("max")).alias("max"),
                    F.when(rng, (F.col("max") - F.col("min")) / F.lit(float(steps))).alias("step"),
                    F.when(~rng, F.col("n_distinct")).alias("n_options")))


def coerce_numeric_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Prefix-parse the given string columns to double (failures become null)."""
    from ..functions.scalar import coerce_numeric
    dtypes = dict(df.dtypes)
    return df.select(*[coerce_numeric(c, dtypes[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def shape(df: DataFrame) -> DataFrame:
    """Q1: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def approx_count(df: DataFrame, fraction: float = 0.1, seed: int = 7, z: float = 1.96) -> DataFrame:
    """Q2: row count estimated from a Bernoulli sample, with an interval of ``z`` standard errors (~95%).

    The sampled count c estimates N as c / f, with standard error
    sqrt(c (1 - f)) / f.
    """
    c = F.count(F.lit(1)).cast("double")
    se = F.sqrt(c * F.lit(1.0 - fraction)) / F.lit(fraction)
    est = c / F.lit(fraction)
    return df.sample(False, fraction, seed).agg(
        F.round(est).cast("bigint").alias("approx_rows"),
        F.greatest(F.lit(0.0), est - F.lit(z) * se).alias("low"),
        (est + F.lit(z) * se).alias("high"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3: nulls per column in one pass (wide: one column per input column)."""
    cols = list(cols) if cols else df.columns
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def null_counts_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3 long form: (column, null_count)."""
    cols = list(cols) if cols else df.columns
    wide = null_counts(df, cols)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"))
                                          for c in cols])))


def estimated_size(df: DataFrame, bytes_per_row: int = 100, measure: bool = False) -> DataFrame:
    """Q4: rows x assumed row width in MiB; ``measure`` also sums the string lengths."""
    rows = F.count(F.lit(1))
    aggs = [rows.alias("rows"), (rows * F.lit(bytes_per_row) / F.lit(1048576.0)).alias("estimated_mb")]
    if measure:
        width = sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        aggs.append((F.sum(width) / F.lit(1048576.0)).alias("measured_mb"))
    return df.agg(*aggs)


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q5: count, mean, stddev, min, max of every column as one row per column.

    Strings are read as numbers where they parse (try_cast); min / max are
    given in string form.  One aggregate pass; never Spark's ``describe``,
    which breaks on a column called ``summary``.
    """
    cols = list(cols) if cols else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs, cells = [], []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        kind = _kind(fields[c])
        if kind in ("number", "boolean"):
            num = col.cast("double")
        elif isinstance(fields[c], T.StringType):
            num = col.try_cast("double")
        else:
            num = F.lit(None).cast("double")
        aggs += [F.count(col).alias(f"n{i}"), F.avg(num).alias(f"m{i}"), F.stddev_samp(num).alias(f"s{i}"),
                 F.min(col).cast("string").alias(f"lo{i}"), F.max(col).cast("string").alias(f"hi{i}")]
        cells.append(F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"),
                              F.col(f"hi{i}").alias("max")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def validate(df: DataFrame, key_cols: Sequence[str], bytes_per_row: int = 100) -> DataFrame:
    """Data-quality summary in one pass: row count, rows with every key column
    null (malformed), nulls per column and the estimated size in MiB.

    The checks run as separate actions would each scan the input; here they
    are one aggregate (P11 + Q3 + Q4 fused).
    """
    malformed = F.lit(True)
    for c in key_cols:
        malformed = malformed & F.col(f"`{c}`").isNull()
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows"), F.count_if(malformed).alias("malformed_rows"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns],
                  (rows * F.lit(bytes_per_row) / F.lit(1048576.0)).alias("estimated_mb"))
