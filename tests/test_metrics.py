"""E5 E8 E10 E11 E12 B8 B10 H12, P15."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from stratus.functions.times import epoch_or_iso
from stratus.operators import metrics


def test_event_rate_counts_per_window(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame(
        [(t.replace(second=s), "A", "c1") for s in range(0, 60, 10)]
        + [(t.replace(minute=1, second=5), "B", "c2")],
        "ts timestamp, city_name string, city_id string")
    r = rows(metrics.event_rate(ev))
    assert r == [(t, "A", 0.1), (t.replace(minute=1), "B", 1 / 60)]
    sliding = metrics.event_rate(ev, slide="10 seconds")
    assert sliding.where("city_name = 'B'").count() == 6
    sel = metrics.event_rate(ev, select={"city_id": ["c2"]})
    assert rows(sel, "city_name") == [("B",)]


def test_histogram_is_cumulative(spark):
    log = spark.createDataFrame([("k", None, 0.004), ("k", "E1", 0.3), ("k", None, 20.0)],
                                "kind string, reason string, sec double")
    h = metrics.latency_histogram(log).collect()[0]
    assert (h.calls, h.failures) == (3, 1)
    # The failed call (0.3 s) counts as a call, but its latency is not observed.
    assert (h.le_0_005, h.le_0_25, h.le_0_5, h.le_10, h.le_inf) == (1, 1, 1, 1, 2)
    assert rows(metrics.failures_by_reason(log)) == [("k", "E1", 1)]


def test_messages_per_poll_and_counts(spark):
    polls = spark.createDataFrame([(1, True), (1, False), (2, True)], "poll int, has_current boolean")
    assert rows(metrics.messages_per_poll(polls)) == [(1, 3, 2), (2, 2, 1)]
    cur = spark.createDataFrame([("a", "A", None), ("a", "A", None), ("b", "B", "FR")],
                                "city_id string, city_name string, country string")
    assert rows(metrics.city_event_counts(cur)) == [("a", "A", "na", 2), ("b", "B", "FR", 1)]


def test_chart_series(spark):
    res = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0, 2.0, "x")],
                                "city_id string, date date, avg_t double, max_w double, other string")
    assert rows(metrics.chart_series(res), "series", "value") == [("avg_t", 1.0), ("max_w", 2.0)]
    assert metrics.chart_series(res.drop("date")).count() == 0
    assert rows(metrics.choices(res, "city_id")) == [("a",)]


def test_epoch_or_iso(spark):
    df = spark.createDataFrame([("1735689600",), ("2025-01-01T00:00:00Z",),
                                ("2025-01-01T01:00:00+01:00",), ("junk",)], "ts string")
    got = [r.t for r in df.select(epoch_or_iso("ts").alias("t")).collect()]
    assert got[:3] == [dt.datetime(2025, 1, 1)] * 3 and got[3] is None
    assert df.select(F.count("ts")).first()[0] == 4
