"""SparkSession helpers shared by tests, the bench and the pipeline."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tallyvault",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the pipeline relies on.

    On a cluster the session is created by the launcher; this helper is
    for tests and the bench.  UTC is pinned because every timestamp in the
    model is zone-less (TIMESTAMP_NTZ) and day boundaries must not move.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.csv.parser.columnPruning.enabled", "false")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.maxMetadataStringLength", "1000")  # partition filters whole in plans
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting always wins.  Only a bare local session (tests) gets a fresh
    scratch folder; on a cluster a folder that only one machine sees would
    lose data, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    path = tempfile.mkdtemp(prefix="tallyvault-ckpt-")
    sc.setCheckpointDir(path)
    return path
