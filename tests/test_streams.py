"""I1-I7 on file sources with availableNow: stream == batch, restarts are exactly-once."""

import datetime as dt
import json
import os

from conftest import raw_event, rows
from pyspark.sql import functions as F

from stratus.operators import batched, flatten, latest
from stratus.sources import files
from stratus.sources.sinks import Sink, publish_requests
from stratus.sources.streams import Source, parse_hourly_messages, read_stream
from stratus.streaming import hourly as sh
from stratus.streaming import live
from stratus.streaming import requests as sr

NOW = {"availableNow": True}


def _write_lines(path, lines, name="part-0.json"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _events():
    return [
        raw_event(city="a", temps=[1.0, 2.0]),
        raw_event(city="b", name="B", temps=[3.0, None], times=["2025-01-01T05:00", "2025-01-01T06:00"]),
        raw_event(drop=("time",)),
        "nope",
    ]


def test_stream_flatten_equals_batch_and_restart_adds_nothing(spark, tmp):
    _write_lines(f"{tmp}/raw", _events())
    batch = flatten.flatten(spark.read.schema("value string").text(f"{tmp}/raw"))
    for run in range(2):  # the second run restarts from the checkpoint
        raw = read_stream(spark, Source("files", path=f"{tmp}/raw"))
        qs = sh.start_hourly(raw, Sink("parquet", path=f"{tmp}/bronze", partition_by=("date",)),
                             Sink("json", path=f"{tmp}/msgs"), f"{tmp}/ckpt", NOW)
        for q in qs:
            q.awaitTermination()
        if run == 0:
            m = qs[0].lastProgress["observedMetrics"]["flatten"]
            assert (m["events"], m["dropped_events"], m["hourly_rows"]) == (4, 2, 4)
    out = spark.read.parquet(f"{tmp}/bronze").select(*batch.columns)
    assert rows(out) == rows(batch) and out.count() == 4
    msgs = parse_hourly_messages(spark.read.json(f"{tmp}/msgs"))
    assert msgs.count() == 4
    assert rows(msgs.where("city_id = 'b'"), "hour_ts") == [
        (dt.datetime(2025, 1, 1, 5),), (dt.datetime(2025, 1, 1, 6),)]


def test_one_pass_mode_writes_both_outputs(spark, tmp):
    _write_lines(f"{tmp}/raw", _events())
    raw = read_stream(spark, Source("files", path=f"{tmp}/raw"))
    qs = sh.start_hourly(raw, Sink("parquet", path=f"{tmp}/bronze"), Sink("json", path=f"{tmp}/msgs"),
                         f"{tmp}/ckpt", NOW, mode="one_pass")
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/bronze").count() == 4
    assert spark.read.json(f"{tmp}/msgs").count() == 4


def test_current_stream(spark, tmp):
    _write_lines(f"{tmp}/raw", _events() + [raw_event(times=[], temps=[], hums=[], winds=[])])
    raw = read_stream(spark, Source("files", path=f"{tmp}/raw"))
    q = sh.start_current(raw, Sink("parquet", path=f"{tmp}/cur"), f"{tmp}/ckpt", NOW)
    q.awaitTermination()
    got = rows(spark.read.parquet(f"{tmp}/cur"), "city_id", "temperature_c")
    assert got == [("a", 2.0), ("b", None), ("paris-fr", 2.5)]


def test_live_latest_update_mode(spark, tmp):
    _write_lines(f"{tmp}/raw", _events())
    raw = read_stream(spark, Source("files", path=f"{tmp}/raw"))
    norm = flatten.flatten(raw).withColumn("fetch_seq", F.lit(0))
    q = live.start_snapshot(live.live_latest(norm), f"{tmp}/out", f"{tmp}/ckpt", NOW, "update")
    q.awaitTermination()
    snap = live.read_updates(spark, f"{tmp}/out", ["city_id", "city_name", "country"])
    got = rows(snap, "city_id", "temperature_2m")
    assert got == [("a", 2.0), ("b", 3.0)]     # b's later hour is NULL: never overwrites


def test_rate_append_mode_emits_closed_windows(spark, tmp):
    ev = [{"ts": f"2025-01-01T00:0{m}:1{s}Z", "city_name": "A"} for m in range(4) for s in range(3)]
    ev.append({"ts": "2025-01-01T00:30:00Z", "city_name": "A"})   # moves the watermark on
    _write_lines(f"{tmp}/ev", [json.dumps(e) for e in ev])
    stream = spark.readStream.schema("ts timestamp, city_name string").json(f"{tmp}/ev")
    rate = live.live_rate(stream, watermark="1 minute")
    q = (rate.writeStream.outputMode("append").format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    # Only the first batch's windows are closed once the 00:30 event moves
    # the watermark; the 00:30 window itself stays open.
    got = spark.read.parquet(f"{tmp}/out")
    assert all(r.rate == 3 / 60 for r in got.collect())
    assert got.where("window_start >= '2025-01-01 00:30:00'").count() == 0


def test_request_stream_results_and_statuses(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    bronze = spark.createDataFrame(
        [("a", "A", "EU", t.replace(hour=h), float(h), 1.0, 2.0, dt.date(2024, 1, 1)) for h in range(3)],
        "city_id string, city_name string, country string, hour_ts timestamp, temperature_2m double, "
        "relative_humidity_2m double, wind_speed_10m double, date date")
    stats = batched.daily_stats(bronze)
    reqs = [
        {"request_id": "ok", "city_ids": ["a"], "metrics": ["temperature_2m"], "agg": "max"},
        {"request_id": "all", "city_ids": [], "metrics": ["wind_speed_10m"], "agg": "avg"},
        {"request_id": "bad", "agg": "sum"},
        {"request_id": "nodate", "date_from": "bad"},
    ]
    _write_lines(f"{tmp}/req", [json.dumps(r) for r in reqs])
    raw = read_stream(spark, Source("files", path=f"{tmp}/req"))
    q = sr.start_requests(raw, stats, f"{tmp}/res", f"{tmp}/status", f"{tmp}/ckpt", NOW)
    q.awaitTermination()
    res = spark.read.parquet(f"{tmp}/res")
    assert rows(res, "request_id", "metric", "value") == [
        ("all", "wind_speed_10m", 2.0), ("ok", "temperature_2m", 2.0)]
    log = files.read_statuses(spark, f"{tmp}/status")
    assert rows(log.where("status = 'submitted'"), "request_id") == [("all",), ("ok",)]
    st = latest.latest_status(log, order_by=("log_offset",))
    got = {r.request_id: (r.status, r.result_path is not None) for r in st.collect()}
    assert got == {"ok": ("success", True), "all": ("success", True),
                   "bad": ("error", False), "nodate": ("error", False)}


def test_asked_again_and_odd_ids(spark, tmp):
    """One answer per id; a later empty answer replaces the earlier one; the
    path in the status exists whatever the id's characters."""
    t = dt.datetime(2024, 1, 1)
    stats = batched.daily_stats(spark.createDataFrame(
        [("a", "A", "EU", t, 1.0, 1.0, 2.0, dt.date(2024, 1, 1))],
        "city_id string, city_name string, country string, hour_ts timestamp, temperature_2m double, "
        "relative_humidity_2m double, wind_speed_10m double, date date"))
    odd = "2025-01-01T10:00"
    ddl = ("request_id string, city_ids array<string>, date_from string, date_to string, "
           "metrics array<string>, agg string, timestamp timestamp, partition int, offset long")
    first = [(odd, ["a"], None, None, ["temperature_2m"], "avg", t, 0, 1),
             (odd, ["a"], None, None, ["wind_speed_10m"], "max", t, 0, 2)]
    again = [(odd, ["zz"], None, None, ["wind_speed_10m"], "max", t, 0, 3)]
    for k, asked in enumerate((first, again)):
        sr.answer_batch(spark.createDataFrame(asked, ddl), stats, f"{tmp}/res", f"{tmp}/status", k)
        log = files.read_statuses(spark, f"{tmp}/status")
        answer = sr.read_answer(spark, log, odd)
        assert rows(answer, "metric", "value") == ([("wind_speed_10m", 2.0)] if k == 0 else [])
    assert sr.read_answer(spark, log, "never") is None
    assert rows(latest.latest_status(log, order_by=("log_offset",)), "status") == [("success",)]


def test_status_ties_follow_the_log(spark, tmp):
    """Equal or misleading clocks: the file written later wins."""
    import time
    for k, (status, ts) in enumerate([("submitted", "2025-01-01T00:00:05Z"), ("success", "1735689600")]):
        _write_lines(f"{tmp}/log/part{9 - k}", [json.dumps({"request_id": "r", "status": status, "ts": ts})])
        time.sleep(0.05)
    from stratus.jobs.status import status_of
    from stratus.sources.streams import parse_statuses, read_log
    assert status_of(spark, files.read_statuses(spark, f"{tmp}/log"), "r").first().status == "success"
    parsed = parse_statuses(read_log(spark, Source("files", path=f"{tmp}/log")))
    assert status_of(spark, parsed, "r").first().status == "success"


def test_publish_requests_fills_ids(spark):
    req = spark.createDataFrame([(None, None, None, None, None, None), ("x", ["a"], "2024-01-01", None,
                                                                      ["wind_speed_10m"], "min")],
                                "request_id string, city_ids array<string>, date_from string, "
                                "date_to string, metrics array<string>, agg string")
    out = publish_requests(req).collect()
    ids = {r.request_id for r in out}
    assert "x" in ids and [len(i) for i in ids - {"x"}] == [36]
    assert all(r.submitted_at.endswith("Z") and r.submitted_by == "streamlit" for r in out)
