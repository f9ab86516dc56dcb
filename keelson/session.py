"""Spark session and shared-folder helpers.

Nothing here hand-schedules work: the settings turn on AQE (runtime
broadcast choice, partition coalescing, skew-join splitting) and pin the
session time zone so feed clocks and timestamps compare the same way on
every executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a replication job relies on. AQE turns a shuffled join into a
# broadcast only after it has measured the materialised side, which is the
# size check that makes a broadcast safe on inputs whose size is unknown
# up front; beyond the threshold the sort-merge plan stays.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition sizing: scans split at 128 MB; after a shuffle AQE merges
    # small partitions up to 128 MB and splits skewed ones, so the initial
    # shuffle partition count only has to be large enough (see README).
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lineage cuts (checkpoint()) are removed once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "keelson", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts, stream checkpoints and
    job scratch tables.

    Read from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir). Only when the session names none - a local test run -
    a private folder is created and registered on the context.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "folder for checkpoints and staged tables")
        current = tempfile.mkdtemp(prefix="keelson-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (never reused between runs)."""
    return os.path.join(shared_dir(spark), "keelson", *parts, uuid.uuid4().hex)
