"""Publish parametric requests (A9): ids, submitter and time filled in.

    python -m stratus.jobs.publish --requests requests.jsonl --out REQUESTS_FOLDER
    python -m stratus.jobs.publish --requests requests.jsonl --bootstrap HOST:PORT
"""

from __future__ import annotations

import argparse

from stratus.schemas import REQUEST_DDL
from stratus.session import get_session
from stratus.sources.sinks import as_messages, publish_requests
from stratus.sources.streams import TOPIC_REQUESTS


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="publish parametric requests")
    p.add_argument("--requests", required=True, help="JSON lines of requests")
    p.add_argument("--out", default=None, help="JSON folder read by jobs.request_stream")
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--topic", default=TOPIC_REQUESTS)
    p.add_argument("--user", default="streamlit")
    a = p.parse_args(argv)
    spark = get_session("stratus-publish", profile="cluster")
    # Written once, so that a retried write cannot draw other ids than those shown.
    rows = publish_requests(spark.read.schema(REQUEST_DDL).json(a.requests), a.user).persist()
    if a.out:
        rows.write.mode("append").json(a.out)
    if a.bootstrap:
        (as_messages(rows).write.format("kafka").option("kafka.bootstrap.servers", a.bootstrap)
         .option("topic", a.topic).save())
    for r in rows.select("request_id").toLocalIterator():
        print(r["request_id"])
    rows.unpersist()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
