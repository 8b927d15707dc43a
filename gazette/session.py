"""Session construction and the few session-level settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job of the engine expects. Dates are compared as calendar days
# and feed timestamps are read in UTC, so the session zone is fixed.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrames are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "gazette",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the SQL settings the engine relies on to an existing session."""
    for k, v in ENGINE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


_shipped: set = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application,
    so that functions of the package run wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="gazette-code-"), "gazette_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join(os.path.basename(root), os.path.relpath(p, root)))
    sc.addPyFile(target)  # served by the driver; executors fetch their own copy
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only when none is configured.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    folder). Only a local-mode session without that setting (tests) gets a
    fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="gazette-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, next to the checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def cluster_conf(input_bytes: int, cores: int, executor_memory_gb: float = 16.0,
                 executor_cores: int = 4, target_partition_mb: int = 256) -> dict:
    """Sizing for a run over ``input_bytes`` of input on ``cores`` cores in
    total, executors of ``executor_memory_gb`` with ``executor_cores`` each.

    Shuffle partitions are sized so a partition is about ``target_partition_mb``
    (it must fit an executor core's share of memory with room to spill), and
    at least two waves of tasks. Scan splits stay at 128 MB. AQE coalesces
    small partitions and splits skewed ones at run time; these are starting
    points, not caps."""
    per_core_mb = executor_memory_gb * 1024 / max(1, executor_cores)
    target = min(target_partition_mb, max(32, int(per_core_mb / 4)))
    parts = max(2 * cores, int(input_bytes / (target * 1024 * 1024)) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
