"""Continuous flatten: raw events -> bronze files + hourly messages.

Two ways to feed the two sinks:

* ``two_queries`` (default): one streaming query per sink, each with its own
  checkpoint; each sink is exactly-once, the source is read twice.
* ``one_pass``: one query, ``foreachBatch`` writes both outputs from one read
  of the micro-batch; each output folder is keyed by the batch id and
  overwritten, so a replayed batch replaces its own files (idempotent).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stratus.operators.current import current_flat
from stratus.operators.flatten import flatten, hourly_payload
from stratus.sources.sinks import Sink, as_messages, stream_writer


def start_hourly(
    raw: DataFrame,
    bronze: Sink,
    payload: Sink | None,
    checkpoint_root: str,
    trigger: dict | None = None,
    mode: str = "two_queries",
    keep_ingested_at: bool = False,
    observe: str | None = "flatten",
) -> list[StreamingQuery]:
    """I1 + I2: start the flatten; returns the running queries (wait on them
    with ``spark.streams.awaitAnyTermination()`` so a failure of either is
    seen).  ``observe`` names the per-batch counters (events, dropped events,
    hourly rows) reported in ``query.lastProgress["observedMetrics"]``."""
    norm = flatten(raw, keep_ingested_at=keep_ingested_at, observe=observe)
    if mode == "two_queries":
        qs = [stream_writer(norm, bronze, os.path.join(checkpoint_root, "bronze"), trigger).start()]
        if payload is not None:
            msgs = hourly_payload(norm)
            qs.append(
                stream_writer(msgs, payload, os.path.join(checkpoint_root, "payload"), trigger).start()
            )
        return qs
    if mode == "one_pass":
        def write_both(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                _write_batch(batch, bronze, batch_id)
                if payload is not None:
                    _write_batch(hourly_payload(batch), payload, batch_id)
            finally:
                batch.unpersist()

        w = norm.writeStream.foreachBatch(write_both).option(
            "checkpointLocation", os.path.join(checkpoint_root, "one_pass")
        )
        if trigger:
            w = w.trigger(**trigger)
        return [w.start()]
    raise ValueError(f"unknown mode {mode!r}")


def _write_batch(df: DataFrame, sink: Sink, batch_id: int) -> None:
    if sink.kind == "kafka":
        (df.write.format("kafka").option("kafka.bootstrap.servers", sink.bootstrap)
         .option("topic", sink.topic).save())
        return
    w = df.write.mode("overwrite")
    if sink.partition_by:
        w = w.partitionBy(*sink.partition_by)
    w.format(sink.kind).save(os.path.join(sink.path, f"batch={batch_id}"))


def start_current(raw: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """I4: raw events -> current observations (T5) -> current topic / folder."""
    cur = current_flat(raw)
    out = as_messages(cur) if sink.kind == "kafka" else cur
    return stream_writer(out, sink, checkpoint, trigger).start()
