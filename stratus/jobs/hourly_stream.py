"""Continuous flatten: raw events (Kafka topic or JSON folder) -> bronze
Parquet + hourly messages (Kafka topic or JSON folder), and optionally the
current observations (I4).

    python -m stratus.jobs.hourly_stream --source files --raw-path IN \
        --bronze OUT --messages MSG --checkpoint CKPT [--trigger "30 seconds"|once]
    python -m stratus.jobs.hourly_stream --source kafka --bootstrap kafka:9092 \
        --bronze OUT --messages-topic weather.hourly.flattened --checkpoint CKPT
"""

from __future__ import annotations

import argparse

from stratus.session import get_session
from stratus.sources.sinks import Sink
from stratus.sources.streams import (
    START_LATEST, TOPIC_CURRENT, TOPIC_HOURLY, TOPIC_RAW, Source, read_stream,
)
from stratus.streaming.hourly import start_current, start_hourly


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="raw events -> hourly rows")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--raw-path", default=None)
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--topic", default=TOPIC_RAW)
    p.add_argument("--starting-offsets", default=START_LATEST)
    p.add_argument("--min-partitions", default=None,
                   help="kafka: split large topic partitions into at least this many tasks")
    p.add_argument("--max-per-trigger", default=None,
                   help="kafka: maxOffsetsPerTrigger; files: maxFilesPerTrigger")
    p.add_argument("--bronze", required=True)
    p.add_argument("--partition-by-date", action=argparse.BooleanOptionalAction, default=True,
                   help="bronze by day, so that jobs over some days read only those")
    p.add_argument("--keep-ingested-at", action=argparse.BooleanOptionalAction, default=True,
                   help="keep the fetch time, which tells the last fetch of an hour")
    p.add_argument("--messages", default=None, help="JSON folder for hourly messages")
    p.add_argument("--messages-topic", default=None, help=f"e.g. {TOPIC_HOURLY}")
    p.add_argument("--current", default=None, help="Parquet folder for current observations (I4)")
    p.add_argument("--current-topic", default=None, help=f"or a topic, e.g. {TOPIC_CURRENT}")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--mode", choices=["two_queries", "one_pass"], default="two_queries")
    p.add_argument("--trigger", default=None, help='"once" (available now) or an interval')
    a = p.parse_args(argv)

    spark = get_session("stratus-hourly", profile="cluster")
    opts = {}
    if a.source == "kafka":
        if a.min_partitions:
            opts["minPartitions"] = a.min_partitions
        if a.max_per_trigger:
            opts["maxOffsetsPerTrigger"] = a.max_per_trigger
    elif a.max_per_trigger:
        opts["maxFilesPerTrigger"] = a.max_per_trigger
    src = Source(a.source, path=a.raw_path, topic=a.topic, bootstrap=a.bootstrap,
                 starting_offsets=a.starting_offsets, options=opts)
    bronze = Sink("parquet", path=a.bronze,
                  partition_by=("date",) if a.partition_by_date else ())
    if a.messages_topic:
        payload = Sink("kafka", topic=a.messages_topic, bootstrap=a.bootstrap)
    elif a.messages:
        payload = Sink("json", path=a.messages)
    else:
        payload = None
    trigger = None
    if a.trigger == "once":
        trigger = {"availableNow": True}
    elif a.trigger:
        trigger = {"processingTime": a.trigger}
    queries = start_hourly(read_stream(spark, src), bronze, payload, a.checkpoint, trigger, a.mode,
                           keep_ingested_at=a.keep_ingested_at)
    if a.current or a.current_topic:
        cur = (Sink("kafka", topic=a.current_topic, bootstrap=a.bootstrap) if a.current_topic
               else Sink("parquet", path=a.current))
        queries.append(start_current(read_stream(spark, src), cur, f"{a.checkpoint}/current", trigger))
    if trigger and "availableNow" in trigger:
        for q in queries:
            q.awaitTermination()
    else:
        # Any failing sink stops the job (a silent half-dead pipeline is worse).
        spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
