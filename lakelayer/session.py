"""Session defaults and the shared work folder.

The library never builds its own session in library code: callers pass one.
``local_session`` exists for tests and ``bench.py`` only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the layer plans rely on. AQE gives runtime broadcast conversion
# (a size-checked broadcast with sort-merge as the fallback), partition
# coalescing and skew-join splitting; all three are Spark defaults, set here so
# a cluster profile that turned them off is visible in the session we build.
# None changes a result; they are performance settings.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not JIT-compile methods over 8000 bytecodes. The gate's
    # expressions over a joined source make whole-stage methods that large;
    # with this limit Spark falls back to per-operator code for them instead
    # of running an interpreted giant method (measured 2-3x faster here).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lakelayer") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Local files list faster on the driver than through a listing job.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "10000")
        .config("spark.driver.memory", "12g")
        # Local runs only: write file:// tables without .crc checksum side files
        # (a cluster writes to HDFS or object storage, where this does not apply).
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; we use it for checkpoints and for the tables the plans write. Only a
    ``local`` session (unit tests on a laptop) gets a folder under the system
    temp dir when nothing is configured; any other session raises.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current and sc is not None:
            sc.setCheckpointDir(current)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = os.path.join(tempfile.gettempdir(), "lakelayer-checkpoints")
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    return current


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder for one run's tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakelayer-work/{label}-{uuid.uuid4().hex[:12]}"
