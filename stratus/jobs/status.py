"""Status of one request (C8 + E6): last message, or ``pending``.

    python -m stratus.jobs.status --status STATUS_FOLDER --request_id r1
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.latest import latest_status
from stratus.session import get_session
from stratus.sources.files import read_statuses
from stratus.sources.streams import START_EARLIEST, TOPIC_RESULTS, Source, parse_statuses, read_log


def status_of(spark: SparkSession, statuses: DataFrame, request_id: str) -> DataFrame:
    """The last status row of one request in the log's own order, whatever
    its writers' clocks say (``pending`` if none)."""
    asked = spark.createDataFrame([(request_id,)], "request_id string")
    one = statuses.where(F.col("request_id") == request_id)
    return latest_status(one, asked=asked, order_by=("log_offset",))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="status of one request")
    p.add_argument("--status", default=None, help="status folder (JSON lines)")
    p.add_argument("--bootstrap", default=None, help="read the status topic instead")
    p.add_argument("--topic", default=TOPIC_RESULTS)
    p.add_argument("--request_id", required=True)
    a = p.parse_args(argv)
    spark = get_session("request-status", profile="cluster")
    if a.bootstrap:
        log = parse_statuses(read_log(spark, Source("kafka", topic=a.topic, bootstrap=a.bootstrap,
                                                    starting_offsets=START_EARLIEST)))
    else:
        log = read_statuses(spark, a.status)
    row = status_of(spark, log, a.request_id).first()
    print(json.dumps({k: v for k, v in row.asDict().items() if v is not None}, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
