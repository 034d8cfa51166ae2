"""E3 E4 E6 E7 E13 G3 H12, P7 P9."""

import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from stratus.operators import dedup, latest, metrics

H = ("city_id string, city_name string, country string, hour_ts timestamp, "
     "temperature_2m double, relative_humidity_2m double, wind_speed_10m double, fetch_seq bigint")


def _hourly(spark, data):
    return spark.createDataFrame(data, H)


def test_latest_null_never_overwrites(spark):
    t = dt.datetime(2024, 1, 1)
    h = _hourly(spark, [
        ("a", "A", "EU", t, 1.0, 10.0, 100.0, 1),
        ("a", "A", "EU", t.replace(hour=1), None, 11.0, None, 2),
        ("a", "A", "EU", t.replace(hour=1), 3.0, None, None, 3),
        ("", "X", "EU", t.replace(hour=5), 9.0, 9.0, 9.0, 4),      # no city id: ignored
        (None, "X", "EU", t.replace(hour=5), 9.0, 9.0, 9.0, 5),
    ])
    assert rows(latest.latest_by_city(h)) == [("a", "A", "EU", 3.0, 11.0, 100.0)]


def test_latest_is_order_invariant(spark):
    t = dt.datetime(2024, 1, 1)
    data = [("a", "A", "EU", t.replace(hour=i % 24), float(i), None, float(-i), i) for i in range(50)]
    ref = rows(latest.latest_by_city(_hourly(spark, data)))
    random.Random(7).shuffle(data)
    assert rows(latest.latest_by_city(_hourly(spark, data).repartition(5))) == ref


def test_latest_by_arrival_order(spark):
    t = dt.datetime(2024, 1, 1)
    h = _hourly(spark, [("a", "A", "EU", t.replace(hour=23), 1.0, 1.0, 1.0, 1),
                        ("a", "A", "EU", t, 2.0, 2.0, 2.0, 2)])
    assert rows(latest.latest_by_city(h, order_by=("fetch_seq",)), "temperature_2m") == [(2.0,)]
    assert rows(latest.latest_by_city(h), "temperature_2m") == [(1.0,)]


S = "request_id string, status string, error string, ts string, log_offset bigint"


def test_latest_status_epoch_or_iso_and_pending(spark):
    s = spark.createDataFrame([
        ("r1", "submitted", None, "1735689600.5", 1),          # 2025-01-01T00:00:00.5Z
        ("r1", "done", None, "2025-01-01T00:00:01Z", 2),
        ("r2", "submitted", None, "2025-01-02T00:00:00+00:00", 3),
        ("r2", "error", "boom", "1735689600", 4),              # older, arrived later
    ], S)
    asked = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "request_id string")
    got = {r.request_id: r.status for r in latest.latest_status(s, asked).collect()}
    assert got == {"r1": "success", "r2": "submitted", "r3": "pending"}


def test_status_rollup(spark):
    ts = spark.createDataFrame([
        (1, "t1", "success", 1), (1, "t2", "success", 2),
        (2, "t1", "success", 1), (2, "t2", None, 5), (2, "t2", "success", 1),
        (3, "t1", "failed", 1),
    ], "run_id bigint, task string, state string, pk bigint")
    runs = spark.createDataFrame([(1, "running"), (4, "success"), (5, "failed")],
                                 "run_id bigint, run_state string")
    r = {x.run_id: (x.status, dict(x.upstream)) for x in latest.status_rollup(ts).collect()}
    assert r[1] == ("success", {"t1": "success", "t2": "success"})
    assert r[2] == ("error", {"t1": "success", "t2": "unknown"})   # null state = failure
    assert r[3][0] == "error"
    f = {x.run_id: (x.status, dict(x.upstream)) for x in latest.status_rollup(ts, runs).collect()}
    assert f[4] == ("success", {"dag_run_state": "success"})
    assert f[5] == ("error", {"dag_run_state": "failed"})
    assert f[1][0] == "success"


def test_sum_latest(spark):
    t = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([
        ("lag", "g", "t", 0, t, 1, 5.0), ("lag", "g", "t", 0, t.replace(hour=1), 2, 7.0),
        ("lag", "g", "t", 1, t, 3, 1.0), ("lag", "h", "t", 0, t, 4, 2.0),
    ], "metric string, consumergroup string, topic string, part int, ts timestamp, seq int, value double")
    out = metrics.sum_latest(s, ["metric", "consumergroup", "topic", "part"], ["consumergroup", "topic"])
    assert rows(out) == [("g", "t", 8.0), ("h", "t", 2.0)]


def test_last_fetch_per_hour(spark):
    t = dt.datetime(2024, 1, 1)
    h = _hourly(spark, [("a", "A", "EU", t, 1.0, 1.0, 1.0, 1), ("a", "A", "EU", t, 2.0, None, 2.0, 5),
                        ("a", "A", "EU", t.replace(hour=1), 3.0, 3.0, 3.0, 2)])
    out = dedup.last_fetch(h)
    assert out.columns == h.columns
    assert rows(out, "hour_ts", "temperature_2m", "relative_humidity_2m") == [
        (t, 2.0, None), (t.replace(hour=1), 3.0, 3.0)]


def test_default_order_on_plain_bronze(spark):
    """A bronze table from the flatten has no fetch_seq: order by the hour
    (then ingested_at when kept)."""
    t = dt.datetime(2024, 1, 1)
    b = spark.createDataFrame(
        [("a", "A", "EU", t, 1.0, None, None), ("a", "A", "EU", t.replace(hour=2), 2.0, None, None)],
        "city_id string, city_name string, country string, hour_ts timestamp, "
        "temperature_2m double, relative_humidity_2m double, wind_speed_10m double")
    assert latest.event_order(b) == ("hour_ts",)
    assert rows(latest.latest_by_city(b), "temperature_2m") == [(2.0,)]
    plan = latest.latest_by_city(b)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan          # single primitive ordering: hash-based
    with_ing = b.withColumn("ingested_at", F.lit("2024-01-01T03:00:00Z"))
    assert latest.event_order(with_ing) == ("hour_ts", "ingested_at")
    assert dedup.last_fetch(with_ing).count() == 2
