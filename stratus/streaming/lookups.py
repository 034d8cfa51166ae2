"""Stream-static joins with the registry.

The registry is opened anew for every micro-batch, so a city added, renamed or
switched off counts from the next batch on, as with a producer that polls its
configuration.  Each batch joins one snapshot only, also when it is replayed after
a restart within the batch: outputs are folders named by the batch id, overwritten
by a replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratus.functions.text import norm_id
from stratus.operators import cities
from stratus.operators.envelope import attach_city, envelope
from stratus.sources.registry import open_registry
from stratus.sources.sinks import Sink

NOT_FOUND = "city not found"


def parse_lookups(raw: DataFrame, ddl: str = "city_id string") -> DataFrame:
    """Lookup requests (JSON ``value``) -> the fields of ``ddl``, ``city_id`` among
    them; a message without one asks for the empty id, which no city has."""
    asked = raw.select(F.from_json("value", ddl).alias("r")).select("r.*")
    return asked.withColumn("city_id", F.coalesce("city_id", F.lit("")))


def _put(df: DataFrame, sink: Sink, batch_id: int, step: str) -> None:
    """One batch's rows to ``<path>/<step>/batch=<id>`` (overwritten) or a topic; as
    JSON where the sink holds text."""
    if sink.kind in ("kafka", "text") and df.columns != ["value"]:
        df = df.select(F.to_json(F.struct("*")).alias("value"))
    if sink.kind == "kafka":
        (df.write.format("kafka").option("kafka.bootstrap.servers", sink.bootstrap)
         .option("topic", sink.topic).save())
    else:
        df.write.mode("overwrite").format(sink.kind).save(f"{sink.path}/{step}/batch={batch_id}")


def _each_batch(stream: DataFrame, registry: str, work, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Run ``work(batch, batch_id, registry rows)`` with the newest registry."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # both outputs of a batch come from one read
        try:
            work(batch, batch_id, open_registry(batch.sparkSession, registry).cities)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def start_lookup(asked: DataFrame, registry: str, sink: Sink, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """D1 on a stream of ``city_id`` rows: active cities to ``found/``, ids that the
    registry of that moment does not have (or has switched off) to ``unknown/``."""
    def work(batch: DataFrame, batch_id: int, registry_rows: DataFrame) -> None:
        found, unknown = cities.lookup(batch, registry_rows)
        _put(found, sink, batch_id, "found")
        _put(unknown.withColumn("error", F.lit(NOT_FOUND)), sink, batch_id, "unknown")

    return _each_batch(asked, registry, work, checkpoint, trigger)


def start_envelopes(replies: DataFrame, registry: str, sink: Sink, checkpoint: str,
                    trigger: dict | None = None, with_current: bool = False) -> StreamingQuery:
    """D2 + B6 on a stream of API replies (``city_id``, ``ingested_at``, ``hourly``):
    raw events with the name and country that the registry has at that moment, to
    ``events/``; replies of cities it does not have, to ``unknown/``."""
    def work(batch: DataFrame, batch_id: int, registry_rows: DataFrame) -> None:
        rows = batch.withColumn("city_id", norm_id("city_id"))
        known = registry_rows.select(F.col("id").alias("city_id"))
        _put(envelope(attach_city(rows, registry_rows), with_current).select("value"), sink, batch_id, "events")
        _put(rows.join(known, "city_id", "left_anti").withColumn("error", F.lit(NOT_FOUND)), sink, batch_id, "unknown")

    return _each_batch(replies, registry, work, checkpoint, trigger)


def read_step(spark: SparkSession, sink: Sink, step: str, schema) -> DataFrame:
    """All rows a step has written so far (without the batch column)."""
    return spark.read.schema(schema).format(sink.kind).option("recursiveFileLookup", True).load(f"{sink.path}/{step}")
