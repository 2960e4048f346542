"""Session construction and the shared folder used for snapshots.

Jobs that read a table and write its next version (upsert, versioned import,
mirror) never overwrite their own input: they write a fresh snapshot directory
under the cluster's shared checkpoint folder (``spark.checkpoint.dir``).  The
folder is taken from the session; a local one is created only when the session
has none, which is the case in tests and local benchmarks.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL configuration.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast uses measured shuffle sizes, so a side is only
    # broadcast after its real size is known to be under the bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "tallyspark") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client: use the session setting
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
    # Unset: a machine-local folder is only right where every task runs in this process.
    master = sc.master if sc is not None else "remote"
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    key = id(spark)
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[key], ignore_errors=True)
        sc.setCheckpointDir(_LOCAL_DIRS[key])
    return sc.getCheckpointDir() or _LOCAL_DIRS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tallyspark", f"{name}-{uuid.uuid4().hex[:12]}")
