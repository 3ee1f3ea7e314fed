"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tablewright") -> SparkSession:
    """A local session for tests and benches (the UI is off: no server)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only where none is set (local tests) a fresh folder is made and set.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tw-ckpt-", dir=os.environ.get("TW_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def workers_find_package(spark: SparkSession) -> None:
    """Python workers of a run from a checkout find this package: its root is
    added to their ``PYTHONPATH`` (on a cluster it is installed or shipped)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tw-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Shuffle partitions follow the data (about ``partition_bytes`` each, at
    least three waves of tasks), AQE coalesces small ones and splits skewed
    join partitions, scans cut files into ``partition_bytes`` splits, and the
    broadcast threshold stays at a size every executor can hold.
    """
    parts = max(total_cores * 3, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
