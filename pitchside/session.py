"""Session helpers.

The library never creates a session behind the caller's back: every
operator takes DataFrames. These helpers are for scripts and tests, and for
the one place that needs reliable storage (``checkpoint_dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans are written for. AQE re-plans joins at runtime from
# real sizes (size-checked broadcast, skew-join splitting, partition
# coalescing), so no operator hard-codes a broadcast of data that can grow.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchside") -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PITCHSIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="pitchside-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    a local-mode session without one gets a scratch folder of its own; on a
    cluster a machine-local folder would not survive the loss of an executor,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()  # with its scheme, so that workers open it where Spark does
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it to a shared folder (HDFS/S3/ABFS) "
            "before running operators that cut lineage"
        )
    path = tempfile.mkdtemp(prefix="pitchside-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
