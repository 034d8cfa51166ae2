"""Stream sources (A1 A8 A15 I7) and the bounded status read (A10).

Kafka and a directory of JSON-lines files are interchangeable: both give a
``value`` text column (Kafka adds ``timestamp``, ``partition``, ``offset`` for
arrival order).  A topic partition that carries a large share of the events
is split into several tasks with the Kafka option ``minPartitions``;
``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` bound each micro-batch.
Kafka needs the ``spark-sql-kafka-0-10_2.13`` package on the classpath; the
file twin needs nothing and is what the tests run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.times import epoch_or_iso
from stratus.sources.files import with_file_order, with_file_place
from stratus.schemas import HOURLY_MESSAGE_DDL, REQUEST_DDL, STATUS_DDL

# Topic names and start policies of the pipeline (fixed values).
TOPIC_RAW = "weather.raw.openmeteo"
TOPIC_HOURLY = "weather.hourly.flattened"
TOPIC_CURRENT = "weather.current.metrics"
TOPIC_REQUESTS = "weather.queries.requests"
TOPIC_RESULTS = "weather.queries.results"
START_LATEST = "latest"      # raw, hourly and request streams
START_EARLIEST = "earliest"  # status reads (the whole log)


@dataclass(frozen=True)
class Source:
    """Where a stream comes from: ``kind`` is ``kafka`` or ``files``."""

    kind: str
    path: str | None = None          # files: directory of JSON lines
    topic: str | None = None         # kafka: topic name
    bootstrap: str | None = None     # kafka: bootstrap servers
    starting_offsets: str = START_LATEST
    options: dict[str, str] = field(default_factory=dict)


def read_stream(spark: SparkSession, src: Source, ordered: bool = False) -> DataFrame:
    """A streaming DataFrame with ``value`` (text) and, for Kafka,
    ``timestamp``, ``partition``, ``offset``; ``ordered`` adds ``log_place`` for files
    (when the file was written, its name, the block in it), as later files count as
    later arrivals.  Lines get their place within a micro-batch (:func:`with_lines`)."""
    if src.kind == "kafka":
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", src.bootstrap)
            .option("subscribe", src.topic)
            .option("startingOffsets", src.starting_offsets)
        )
        for k, v in src.options.items():
            r = r.option(k, v)
        return r.load().select(
            F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset"
        )
    if src.kind == "files":
        r = spark.readStream.schema("value string")
        for k, v in src.options.items():
            r = r.option(k, v)
        lines = r.text(src.path)
        return with_file_place(lines, "log_place") if ordered else lines
    raise ValueError(f"unknown source kind {src.kind!r}")


def with_lines(batch: DataFrame) -> DataFrame:
    """A micro-batch as read (no shuffle yet) with ``log_offset``: its ``log_place``
    and the order of the lines."""
    if "log_place" not in batch.columns:
        return batch
    row = F.monotonically_increasing_id().alias("row")
    return batch.withColumn("log_offset", F.struct("log_place.*", row)).drop("log_place")


def read_log(spark: SparkSession, src: Source) -> DataFrame:
    """A10: the whole topic or folder as a bounded batch (earliest..latest)."""
    if src.kind == "kafka":
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", src.bootstrap)
            .option("subscribe", src.topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
            .select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")
        )
    return with_file_order(spark.read.schema("value string").option("recursiveFileLookup", True).text(src.path))


def parse_requests(df: DataFrame) -> DataFrame:
    """Request JSON -> typed request columns (plus arrival columns kept)."""
    extra = [c for c in df.columns if c != "value"]
    return df.select(*extra, F.from_json("value", REQUEST_DDL).alias("r")).select(*extra, "r.*")


def parse_hourly_messages(df: DataFrame) -> DataFrame:
    """Hourly message JSON -> typed columns; ``hour_ts`` back to a timestamp."""
    extra = [c for c in df.columns if c != "value"]
    p = df.select(*extra, F.from_json("value", HOURLY_MESSAGE_DDL).alias("m")).select(*extra, "m.*")
    return p.withColumn("hour_ts", F.try_to_timestamp("hour_ts"))


def parse_statuses(df: DataFrame) -> DataFrame:
    """A10: status message JSON -> status columns, ``ts`` normalised to
    ``ts_norm`` (epoch or ISO), and ``log_offset``, the message's place in the
    log: (timestamp, partition, offset) of the broker, or the file order."""
    extra = [c for c in df.columns if c != "value"]
    p = df.select(*extra, F.from_json("value", STATUS_DDL).alias("s")).select(*extra, "s.*")
    if "offset" in extra:
        p = p.withColumn("log_offset", F.struct("timestamp", "partition", "offset"))
    return p.withColumn("ts_norm", epoch_or_iso("ts"))
