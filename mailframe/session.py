"""Spark session helpers.

The library never creates a cluster session on its own; ``get_session`` is
for tests, the bench and local runs.  On a cluster the caller's session is
used as-is; we only read settings from it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(cpus: int | str = "*", app: str = "mailframe", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # rows carry whole message bodies: keep Arrow batches small in P1
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        # ... and by bytes, so a batch of messages with large attachments stays bounded
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only a local session that names none (tests) gets a scratch folder; on a cluster
    a machine-local folder would be seen by one machine alone, so that is an error.
    """
    context = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not current:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="mailframe-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint dir for a written table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
