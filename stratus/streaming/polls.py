"""Per-poll counters from observed metrics.

The stream that sends a poll's messages observes how many there were; a listener
writes one row per micro-batch when Spark reports its progress.  The counts come
from the batch that was sent, in the same job, and no second read of the data.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from stratus.sources.fs import Store

OBSERVED = "poll"
POLL_DDL = "batch_id long, poll long, messages long, cities long, observed_at string"


def observed(values: DataFrame, poll: str = "poll", name: str = OBSERVED) -> DataFrame:
    """``values`` (one row per city of a poll, with ``has_current``) with the poll's
    counters attached: 2 messages for a city with a current value, 1 without."""
    return values.observe(
        name, F.max(poll).alias("poll"), F.sum(F.when(F.col("has_current"), 2).otherwise(1)).alias("messages"),
        F.count(F.lit(1)).alias("cities"))


class PollListener(StreamingQueryListener):
    """Writes ``<path>/batch=<id>.json`` per micro-batch that had rows.  The name is
    taken once: a batch that is run again after a restart is not counted again."""

    def __init__(self, spark: SparkSession, path: str, name: str = OBSERVED):
        self.store, self.path, self.name = Store(spark), path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is None or not seen["cities"]:
            return
        row = {"batch_id": event.progress.batchId, "poll": seen["poll"], "messages": seen["messages"],
               "cities": seen["cities"], "observed_at": event.progress.timestamp}
        self.store.write_new(f"{self.path}/batch={event.progress.batchId}.json", json.dumps(row) + "\n")


def read_polls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POLL_DDL).json(path)


def await_polls(query: StreamingQuery, spark: SparkSession, path: str, seconds: float = 30.0) -> None:
    """Wait for the end of ``query`` and for the row of its last batch: progress is
    reported on a thread of its own."""
    query.awaitTermination()
    last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=None)
    store, until = Store(spark), time.monotonic() + seconds
    while last is not None and not store.exists(f"{path.rstrip('/')}/batch={last}.json"):
        if time.monotonic() > until:
            raise TimeoutError(f"no counters for batch {last} after {seconds} s")
        time.sleep(0.1)
