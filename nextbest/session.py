"""Session helpers for tests, the bench and scripts.

Library code never builds a session: every operator takes DataFrames from the
caller's session.  These helpers only exist for local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "nextbest") -> SparkSession:
    """A local[N] session with AQE on and the web UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("NEXTBEST_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; if it
    is missing there, this raises instead of inventing a machine-local folder.
    Only in local mode (tests, bench) a scratch folder is made and registered.
    Checkpoints go when Spark's cleaner finds them unused, if the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                           "object store); nextbest checkpoints ranked rows there")
    local = tempfile.mkdtemp(prefix="nextbest-ckpt-")
    sc.setCheckpointDir(local)
    return local
