"""Batch readers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.times import epoch_or_iso
from stratus.operators.daily import partition_presence, require_columns
from stratus.schemas import GOLD_DDL, HOURLY_MESSAGE_DDL, STATUS_DDL


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared test table, e.g. ``events`` -> ``{sf_dir}/events.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_bronze(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """A2 (+A3): the hourly table; partition columns are discovered."""
    df = spark.read.parquet(path)
    return require_columns(df) if check else df


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry at ``path`` (a JSON document, or a folder of versions, of
    which the newest counts) -> (version, updated_at, updated_by, city columns...),
    one row per city.  A missing path reads as an empty registry; one that holds
    no registry raises (:func:`stratus.sources.registry.open_registry`)."""
    from stratus.sources.registry import open_registry

    return open_registry(spark, path).table


def read_registry_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A12 for folders written by ``write_registry`` (one city per line)."""
    ddl = ("version int, updated_at string, updated_by string, id string, name string, "
           "country string, lat double, lon double, active boolean")
    return spark.read.schema(ddl).json(f"{root}/v={version}")


#: Order of a row in a folder of files: when its file was written, then the file,
#: then the row in it.  Splits of a file keep their order; nothing depends on how
#: Spark packs files into tasks.
FILE_ORDER = ("struct<written:timestamp,file:string,block:bigint,row:bigint>")


def with_file_place(df: DataFrame, name: str) -> DataFrame:
    """``df`` (a file scan) with the place of each row's block: when its file was
    written, the file, the block's start."""
    m = F.col("_metadata")
    return df.withColumn(name, F.struct(m["file_modification_time"].alias("written"), m["file_path"].alias("file"),
                                        m["file_block_start"].alias("block")))


def with_file_order(df: DataFrame, name: str = "log_offset") -> DataFrame:
    """``df`` (a file scan) with each row's :data:`FILE_ORDER` position."""
    row = F.monotonically_increasing_id().alias("row")
    return with_file_place(df, "_place").withColumn(name, F.struct("_place.*", row)).drop("_place")


def read_statuses(spark: SparkSession, path: str) -> DataFrame:
    """A10: the whole status log (JSON lines); ``ts`` normalised to a
    timestamp in ``ts_norm``; arrival order in ``log_offset``."""
    if not _exists(spark, path):
        return empty(spark, STATUS_DDL + f", ts_norm timestamp, log_offset {FILE_ORDER}")
    df = with_file_order(spark.read.schema(STATUS_DDL).option("recursiveFileLookup", True).json(path))
    return df.withColumn("ts_norm", epoch_or_iso("ts"))


def read_parquet_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet folder by its known schema; empty if nothing was written yet."""
    return spark.read.schema(ddl).parquet(path) if _exists(spark, path) else empty(spark, ddl)


def stored_day_presence(spark: SparkSession, path: str, day: str) -> DataFrame:
    """A17 on a stored, date-partitioned table without reading a row: the day's
    partition is pruned to and its count comes from the Parquet footers.

    Footer aggregates need the newer Parquet source, so the plan is made in a
    session of its own (same application, no setting of ``spark`` changes).
    """
    if not _exists(spark, path):
        return partition_presence(empty(spark, GOLD_DDL), day)
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return partition_presence(own.read.schema(GOLD_DDL).parquet(path), day)


def read_hourly_messages(spark: SparkSession, path: str) -> DataFrame:
    """A15 (batch): hourly messages (key, value JSON) -> typed columns."""
    raw = spark.read.parquet(path)
    return raw.select("key", F.from_json("value", HOURLY_MESSAGE_DDL).alias("v")).select(
        "key", "v.*"
    )


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A query result folder; all Parquet part files, nothing else.
    An absent folder reads as empty."""
    if not _exists(spark, path):
        return empty(spark, "city_id string, city_name string, country string, date date")
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def holds(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether the folder has a file whose name matches ``pattern``."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)  # noqa: SLF001
    return bool(found)


def _exists(spark: SparkSession, path: str) -> bool:
    # Ask the cluster's file system (HDFS, object store, local) through the
    # Hadoop API, not the driver's local disk.
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)
