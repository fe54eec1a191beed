"""Session construction and shared-storage helpers.

Library code never sets cluster-wide knobs on a session it did not create; the
``build_session`` helper is for local runs, tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale and are safe on any cluster: AQE re-plans joins
# and coalesces/splits shuffle partitions from runtime sizes, so one setting of
# ``spark.sql.shuffle.partitions`` serves every stage from sf0.001 to 100 TB.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole document texts go through the one pandas UDF: bound a batch by rows
    # so a batch of the longest texts (~120 KB each) stays a few hundred MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "ledgerline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the scale defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's own process (``local[...]``)."""
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect: a remote server
        return False
    return master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local master, whose tasks share
    the driver's disk, falls back to a private folder when it is unset; on a
    cluster an unset folder is an error, because executors would each write to
    their own disk.
    """
    found = _context_checkpoint_dir(spark)
    if found:
        return found
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        try:
            spark.sparkContext.setCheckpointDir(configured)
        except Exception:  # Spark Connect: the server owns the context
            pass
        return configured
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return _context_checkpoint_dir(spark) or local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-scratch"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders (call when no result that reads them is needed any more)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
