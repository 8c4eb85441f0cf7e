"""Derived tables written once per application and read back by every query.

The review and flow views join the largest tables.  Every
analysis over them would otherwise repeat the same shuffles; instead the
join result is written as parquet into the shared checkpoint folder the
first time it is needed (the "convert once, analyse parquet" step of the
loader) and later queries scan only the columns they use.  A written table
also cuts lineage: losing an executor after the write never re-runs the
joins.  A table is written anew when the size or time of a source file has
changed; older copies stay until the checkpoint folder is cleaned.

Set ``spark.revlens.materialize=false`` to always plan the joins inline.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import application_id, checkpoint_root

_LOCK = threading.Lock()
_PATHS: dict[tuple[str, str], str] = {}


def enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.revlens.materialize", "true").lower() == "true"


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Names, sizes and times of the files below ``paths``, as one digest (file contents are not read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
             .select(F.xxhash64("path", "length", "modificationTime").alias("a"),
                     F.xxhash64("modificationTime", "length", "path").alias("b")))
    # sums do not depend on the order of the files, so no task gathers their names
    row = files.agg(F.count("*"), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in ("a", "b")]).first()
    return "|".join(map(str, row))


def stored(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """Return ``build()`` as a table written once per (application, name, state of the source files)."""
    app = application_id(spark)
    key = (app, f"{name}|{fingerprint(spark, sources)}")
    with _LOCK:
        path = _PATHS.get(key)
        if path is None:
            digest = hashlib.sha1("|".join(key).encode()).hexdigest()[:16]
            path = f"{checkpoint_root(spark)}/derived-{name}-{digest}"
            build().write.mode("overwrite").parquet(path)
            _PATHS[key] = path
    return spark.read.parquet(path)


def forget(spark: SparkSession) -> None:
    """Drop the registry for this application (the files stay for the cleaner)."""
    app = application_id(spark)
    with _LOCK:
        for k in [k for k in _PATHS if k[0] == app]:
            del _PATHS[k]
