"""Session helpers: one place for the settings every job relies on.

The library never builds its own session inside an operator; callers pass a
``SparkSession``.  ``get_spark`` exists for tests, ``bench.py`` and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for correctness (UTC, ANSI) or for scale (AQE re-plans
# joins, coalesces small shuffles and splits skewed partitions at run time).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only what the planner has measured to be small; beyond this
    # bound the join falls back to a shuffled hash / sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # AQE merges small shuffle partitions towards this size; it never splits
    # beyond the initial count, so that count must be sized to the data.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024, minimum: int = 8) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``.

    AQE coalesces partitions that turn out small, so start from one partition
    per ``target_bytes`` of input (100 TB -> ~400k) rather than Spark's 200,
    which would put ~500 GB in each at that size.
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "revlens", extra: dict | None = None,
              input_bytes: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes:
        if shuffle_partitions is None:
            shuffle_partitions = shuffle_partitions_for(input_bytes)
        # on a shared cluster size partitions by bytes, not by idle cores
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem the
    cluster names).  Only when it is unset *and* the master is local (tests,
    bench) do we create a private temporary folder and register it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder")
        return configured.rstrip("/")
    if sc.applicationId in _LOCAL_ROOTS:
        return _LOCAL_ROOTS[sc.applicationId]
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")  # with its scheme: a bare path would go to the default file system
    app = sc.applicationId
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(HDFS/S3/ABFS) before running revlens jobs on a cluster")
    root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("REVLENS_TMP", "/tmp"))
    sc.setCheckpointDir(root)
    _LOCAL_ROOTS[app] = (sc.getCheckpointDir() or root).rstrip("/")
    return _LOCAL_ROOTS[app]


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", "connect")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
