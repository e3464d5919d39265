"""Spark session defaults used by tests, bench and the CLI.

On a cluster the session is created by the platform.  Only two settings are forced on it, because results
depend on them (time zone, ANSI); everything else (adaptive execution, shuffle partitions,
checkpoint folder) stays as the cluster has it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.
REQUIRED_CONF = {
    # calendar keys and whole-day durations are computed on naive timestamps;
    # pin the zone so session-local conversions never shift a day
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "basketry") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only JVM
            builder = builder.config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "8g"))
    builder = builder.config("spark.ui.enabled", "false") \
                     .config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured and the master is
    local (tests) a scratch folder is created and registered.  On a cluster
    a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        # a machine-local folder is not visible to other executors: stages and
        # checkpoints must live on the cluster's shared file system
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                           "before running on a cluster")
    local = tempfile.mkdtemp(prefix="basketry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()
