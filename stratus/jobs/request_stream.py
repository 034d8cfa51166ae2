"""Request service: request stream -> batched answers + status rows.

    python -m stratus.jobs.request_stream --source files --requests IN \
        --stats GOLD_STATS --results OUT --status STATUS --checkpoint CKPT
"""

from __future__ import annotations

import argparse

from stratus.session import get_session
from stratus.sources.sinks import Sink
from stratus.sources.streams import START_LATEST, TOPIC_REQUESTS, Source, read_stream
from stratus.streaming.requests import start_requests


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="answer parametric requests as they arrive")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--requests", default=None, help="JSON folder of requests")
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--topic", default=TOPIC_REQUESTS)
    p.add_argument("--stats", required=True, help="per-metric daily stats (jobs.daily --stats)")
    p.add_argument("--results", required=True)
    p.add_argument("--status", required=True)
    p.add_argument("--status-topic", default=None, help="also publish statuses there (kafka)")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--trigger", default="10 seconds", help="time between micro-batches")
    p.add_argument("--once", action="store_true", help="answer what is there, then stop")
    a = p.parse_args(argv)
    spark = get_session("query-runner", profile="cluster")
    src = Source(a.source, path=a.requests, topic=a.topic, bootstrap=a.bootstrap,
                 starting_offsets=START_LATEST)
    topic = Sink("kafka", topic=a.status_topic, bootstrap=a.bootstrap) if a.status_topic else None
    q = start_requests(read_stream(spark, src, ordered=True), a.stats, a.results, a.status, a.checkpoint,
                       {"availableNow": True} if a.once else {"processingTime": a.trigger}, topic)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
