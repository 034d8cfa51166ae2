"""Live gauges: latest value per city and event rate per city.

    python -m stratus.jobs.live --source files --messages HOURLY_MSGS \
        --latest-out LATEST --checkpoint CKPT [--current CURRENT_OBS --rate-out RATE]

* latest (I3): hourly messages -> latest non-null value per metric and city;
  the whole (bounded: one row per city) table is rewritten each trigger.
  ``--order arrival`` (Kafka timestamp/partition/offset; files by the time they were
  written, then name) or ``event_time`` (the hour, then arrival).
* rate (I5, optional): current observations -> events per second per city
  in 1-minute windows with a watermark; closed windows are appended.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from stratus.operators.latest import ARRIVAL, latest_by_city
from stratus.schemas import CURRENT_OBS_DDL
from stratus.session import get_session
from stratus.sources.files import holds
from stratus.sources.streams import (
    START_LATEST, TOPIC_CURRENT, TOPIC_HOURLY, Source, parse_hourly_messages, read_stream,
)
from stratus.streaming.live import live_rate, start_snapshot


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="live latest values and rates")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--messages", default=None, help="JSON folder of hourly messages")
    p.add_argument("--messages-topic", default=TOPIC_HOURLY)
    p.add_argument("--order", choices=["arrival", "event_time"], default=None)
    p.add_argument("--latest-out", required=True)
    p.add_argument("--current", default=None, help="folder of current observations")
    p.add_argument("--current-format", choices=["auto", "parquet", "json"], default="auto",
                   help="files: Parquet as jobs.hourly_stream writes them, or JSON lines")
    p.add_argument("--state-partitions", type=int, default=64,
                   help="state partitions per query (one row per city or open window: few)")
    p.add_argument("--current-topic", default=TOPIC_CURRENT)
    p.add_argument("--rate-out", default=None)
    p.add_argument("--watermark", default="2 minutes")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--once", action="store_true")
    a = p.parse_args(argv)
    spark = get_session("live-gauges", profile="cluster")
    # AQE does not coalesce stateful streams, and their number of partitions is
    # fixed by the first run, so it is not the batch jobs'.
    spark.conf.set("spark.sql.shuffle.partitions", str(a.state_partitions))
    trigger = {"availableNow": True} if a.once else {"processingTime": "10 seconds"}

    msgs = read_stream(spark, Source(a.source, path=a.messages, topic=a.messages_topic,
                                     bootstrap=a.bootstrap, starting_offsets=START_LATEST), ordered=True)
    arrival = ARRIVAL
    if a.source == "files":
        # A JSON-lines folder of (key, value) records: take the value text.
        # The file's place is the arrival; of one file's messages the largest counts.
        value = F.get_json_object("value", "$.value")
        msgs = msgs.select(value.alias("value"), F.struct("log_place.*", value.alias("text")).alias("log_place"))
        arrival = ("log_place",)
    hourly = parse_hourly_messages(msgs)
    order = a.order or ("arrival" if a.source == "kafka" else "event_time")
    by = arrival if order == "arrival" else ("hour_ts", *arrival)  # one hour's later message wins
    queries = [start_snapshot(latest_by_city(hourly, order_by=by), a.latest_out,
                              f"{a.checkpoint}/latest", trigger, "complete")]

    if a.rate_out:
        fmt = a.current_format
        if fmt == "auto":
            fmt = "json" if a.source == "kafka" or holds(spark, a.current, "*.json") else "parquet"
        if a.source == "files" and fmt == "parquet":
            obs = spark.readStream.schema(CURRENT_OBS_DDL).parquet(a.current)
        else:
            cur = read_stream(spark, Source(a.source, path=a.current, topic=a.current_topic,
                                            bootstrap=a.bootstrap, starting_offsets=START_LATEST))
            obs = cur.select(F.from_json("value", CURRENT_OBS_DDL).alias("o")).select("o.*")
        rate = live_rate(obs.withColumn("ts", F.try_to_timestamp("ts")), watermark=a.watermark)
        w = (rate.writeStream.outputMode("append").format("parquet")
             .option("path", a.rate_out).option("checkpointLocation", f"{a.checkpoint}/rate")
             .trigger(**trigger))
        queries.append(w.start())
    if a.once:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
