"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. The zone fixes every date cast; the skew-join settings
# let AQE split a hot key of a fact table that meets a unique-key dimension.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # What a task reads, so that its memory does not grow with the tables: rows
    # of ids take ten times their compressed size and more in a hash map or sort.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
# Shuffles are cut into at least so many parts, of which AQE puts small ones
# together again: 3 GB of compressed shuffle at the size above. A session with
# more shuffle partitions has as many.
PARTS = 400


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session (all are runtime settings)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    parts = max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    a cluster session without it is an error, since a machine-local folder
    would be lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="scriptorium-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/scriptorium/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, keeps row order
    and partition numbers for later stages."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
