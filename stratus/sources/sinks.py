"""Writers (A4-A7 A9 A11 A13 A14).

Stream sinks are exactly-once per query: file sinks through their
``_spark_metadata`` log, Kafka through the checkpoint (at-least-once on the
broker side).  Batch writers never read and overwrite the same path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from stratus.functions.times import now_iso


@dataclass(frozen=True)
class Sink:
    """Where a stream goes: ``kind`` is ``kafka``, ``parquet`` or ``json``."""

    kind: str
    path: str | None = None
    topic: str | None = None
    bootstrap: str | None = None
    partition_by: tuple[str, ...] = ()


def stream_writer(df: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None = None,
                  output_mode: str = "append") -> DataStreamWriter:
    """A configured ``writeStream`` (call ``.start()``).

    ``trigger`` is passed to ``.trigger(**trigger)``, e.g.
    ``{"availableNow": True}`` in tests or ``{"processingTime": "30 seconds"}``.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if sink.kind == "kafka":
        w = w.format("kafka").option("kafka.bootstrap.servers", sink.bootstrap).option(
            "topic", sink.topic
        )
    elif sink.kind in ("parquet", "json"):
        w = w.format(sink.kind).option("path", sink.path)
        if sink.partition_by:
            w = w.partitionBy(*sink.partition_by)
    else:
        raise ValueError(f"unknown sink kind {sink.kind!r}")
    if trigger:
        w = w.trigger(**trigger)
    return w


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> (key, value JSON) message rows for a topic or a JSON folder."""
    cols = [c for c in df.columns if c != key]
    value = F.to_json(F.struct(*cols)).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def publish_requests(requests: DataFrame, submitted_by: str = "streamlit") -> DataFrame:
    """Fill a missing id with a random UUID, stamp submitter and time."""
    return requests.select(
        F.coalesce(F.nullif(F.col("request_id"), F.lit("")), F.expr("uuid()")).alias("request_id"),
        F.coalesce("city_ids", F.array().cast("array<string>")).alias("city_ids"),
        "date_from", "date_to",
        F.coalesce("metrics", F.array(F.lit("temperature_2m"))).alias("metrics"),
        F.coalesce("agg", F.lit("avg")).alias("agg"),
        F.lit(submitted_by).alias("submitted_by"),
        now_iso().alias("submitted_at"),
    )


def write_registry(registry: DataFrame, root: str, version: int, updated_by: str) -> str:
    """Write the registry as a *new* version folder ``{root}/v={version}``,
    one JSON line per city carrying the document fields (no single-row
    document is built, so the write is spread over tasks), never overwriting
    the folder it was read from.  Read back with ``read_registry_version``."""
    rows = registry.select(
        F.lit(version).alias("version"), now_iso().alias("updated_at"),
        F.lit(updated_by).alias("updated_by"),
        "id", "name", "country", "lat", "lon", "active",
    )
    path = f"{root}/v={version}"
    rows.write.mode("errorifexists").json(path)
    return path


def append_json(df: DataFrame, path: str) -> None:
    """A11 (batch): append rows as JSON lines."""
    df.write.mode("append").json(path)
