"""Spark session defaults shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: times are UTC (the API sends UTC and keys are
# printed with a literal 'Z'), ANSI stays on (bad input goes through try_*
# functions), AQE re-plans joins and coalesces partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster over a large Parquet lake ("cluster" profile).
# Each is applied only where the cluster configuration has not set it.
CLUSTER_DEFAULTS = {
    # Scan splits and post-shuffle partitions of ~256 MB: few tasks per TB,
    # each fitting executor memory; AQE coalesces small shuffle partitions
    # and splits skewed ones.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Streaming state (latest per city, windows) in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    app: str = "stratus",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so ``spark-submit --master`` wins on a
    cluster.  ``spark.checkpoint.dir`` is taken from the cluster config; a
    scratch folder is made only when none is configured (local runs, tests).
    ``profile="cluster"`` adds :data:`CLUSTER_DEFAULTS` where unset.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if profile == "cluster":
        for k, v in CLUSTER_DEFAULTS.items():
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names it); a scratch one is
    made only when it is unset on a ``local`` master, as in tests.  On a cluster
    a machine-local folder would lose data, so the setting is required there.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or _LOCAL_CKPT.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="stratus-ckpt-")
        _LOCAL_CKPT[sc.applicationId] = d
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    return os.path.join(checkpoint_dir(spark), *parts)
