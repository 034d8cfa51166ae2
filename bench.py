"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Setup (not timed) materialises what the pipeline stores: the raw event files
(envelopes), the bronze hourly table partitioned by ``date`` and the daily
stats table.  Each query then runs from storage to a ``noop`` sink (full
execution, nothing collected to the driver).  Reported per query: median of 3
warm runs after one warm-up.  Prints one JSON line.  ``BENCH_EVENTLOG=1``
also writes Spark's event log (stage and task times) to the scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stratus.operators import batched, daily, dedup, envelope, flatten, latest, metrics  # noqa: E402
from stratus.operators import paramquery  # noqa: E402
from stratus.plans import views as V  # noqa: E402
from stratus.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name.replace("sf", ""))
    except ValueError:
        return name


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="stratus-bench-")
    extra = {"spark.checkpoint.dir": os.path.join(scratch, "ckpt"), "spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENTLOG"):
        # Stage/task timings without the UI: Spark's event log in the scratch folder.
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.path.join(scratch, "events")})
    spark = get_session("stratus-bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS * 2,
                        extra=extra)
    raw_path = os.path.join(scratch, "raw")
    bronze_path = os.path.join(scratch, "bronze")
    hourly = V.hourly(spark, SF_DIR)
    envelope.envelope(envelope.replies_from_hourly(hourly)).select("value").write.text(raw_path)
    hourly.write.partitionBy("date").parquet(bronze_path)
    stats_path = os.path.join(scratch, "stats")
    batched.write_stats(batched.daily_stats(spark.read.parquet(bronze_path)), stats_path)

    def bronze():
        return spark.read.parquet(bronze_path)

    p_narrow = paramquery.resolve(
        request_id="bench-narrow", city_ids=["c1", "c2", "c3", "c42"],
        date_from="2024-01-08", date_to="2024-01-21",
        metrics=["temperature_2m", "relative_humidity_2m"], agg="avg",
    )
    p_all = paramquery.resolve(request_id="bench-all", metrics=list(
        ("temperature_2m", "relative_humidity_2m", "wind_speed_10m")), agg="max")

    queries = {
        "flatten": lambda: flatten.flatten(spark.read.text(raw_path)),
        "daily_weather": lambda: daily.daily_aggregate(bronze()),
        "param_narrow": lambda: paramquery.param_query(bronze(), p_narrow, ordered=False),
        "param_all_cities": lambda: paramquery.param_query(bronze(), p_all, ordered=False),
        "latest_by_city": lambda: latest.latest_by_city(bronze()),
        "daily_stats_build": lambda: batched.daily_stats(bronze()),
        "batched_requests": lambda: batched.batched_from_stats(
            spark.read.parquet(stats_path), V.requests(spark)),
        "batched_many_requests": lambda: batched.batched_from_stats(
            spark.read.parquet(stats_path), V.order_requests(spark, SF_DIR)),
        "hourly_dedup": lambda: dedup.last_fetch(bronze()),
        "event_rate_1m": lambda: metrics.event_rate(V.city_events(spark, SF_DIR)),
        "status_rollup": lambda: latest.status_rollup(V.task_states(spark, SF_DIR)),
    }

    def run(build) -> float:
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for name, build in queries.items():
        run(build)  # warm-up
        results[name] = round(statistics.median(run(build) for _ in range(RUNS)), 3)

    rows = spark.read.parquet(bronze_path).agg(F.count(F.lit(1))).first()[0]
    out = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "bronze_rows": rows,
        "runs": RUNS,
    }
    if os.environ.get("BENCH_EVENTLOG"):
        out["event_log"] = os.path.join(scratch, "events")
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
