"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
         "boolean": pa.bool_(), "binary": pa.binary(),
         "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
         "array<int>": pa.list_(pa.int32())}

#: Texts handed to a function at once; the batch itself is bounded by Spark (64 MB).
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one that the cluster names in spark.checkpoint.dir."""
    from ..session import scratch_path
    return scratch_path(spark, label)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application (as --py-files would)."""
    from ..session import application_id
    with _LOCK:
        if (app := application_id(spark)) in _SHIPPED:
            return
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(top):
                for name in sorted(files):
                    if name.endswith(".py"):
                        own = os.path.join(folder, name)
                        z.write(own, os.path.relpath(own, os.path.dirname(top)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_texts(docs: DataFrame, fn: Callable[[list], Sequence], fields: Sequence[tuple[str, str]],
              id_col: str = "doc_id", text_col: str = "text", id_as: str | None = None,
              carry: bool = False) -> DataFrame:
    """Apply ``fn`` to slices of whole texts; one output row for each input row.

    ``fn`` takes a list of texts (null: None) and returns one list or array
    for each of ``fields`` ((name, type) pairs).  The result has the id and
    these fields.  With ``carry`` the whole input row comes along as the
    struct ``row``, so that columns of the input never clash with the fields.
    """
    id_as = id_as or id_col
    cols = [F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")]
    schema = [T.StructField(id_as, docs.schema[id_col].dataType)]
    if carry:
        cols.append(F.struct("*").alias("_row"))
        schema.append(T.StructField("row", T.StructType(docs.schema.fields)))
    schema += [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]
    types = [ARROW[t] for _, t in fields]
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = fn(part.column(1).to_pylist())
                out = [part.column(0)] + ([part.column(2)] if carry else [])
                out += [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(out, names)

    return arrow_map(docs.select(*cols), run, T.StructType(schema))
