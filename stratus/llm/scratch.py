"""Lineage cuts: intermediate tables in the shared folder.

Tables are written under ``spark.checkpoint.dir`` (read from the session, see
:func:`stratus.session.checkpoint_dir`), so every executor and the driver see
them and a lost executor costs one task, not the whole lineage.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.session import scratch_path


#: A list of ids is broadcast up to this many rows (8 bytes each).
MAX_BROADCAST = 2_000_000


#: Bytes of an Arrow batch sent to a task's Python, about (a longer row goes alone).
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound this session's Arrow batches, unless their size was set.

    Spark's own 64 MB are held several times over by every task (the batch and
    the stream's buffer, each grown by doubling, and what Python makes of it),
    beside the executor's heap.  No result depends on where batches are cut.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


class Scratch:
    """One query's intermediate tables; :meth:`drop` frees those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return it read back (same columns)."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables by name.  Only for tables no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(n))
            p.getFileSystem(conf).delete(p, True)

    def free(self) -> None:
        """Let Spark delete the shuffle files of plans that are no longer held:
        its cleaner acts when the driver's JVM collects their handles."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows.

    Beyond that the join is left to Spark (shuffled, split by AQE where skewed).
    The count stops at the bound.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
