"""Streams with state of their own: registry joins (D1 D2), failing requests (I6),
counters (E5 E10 E11), sums with retraction (E13), poll counters (E8), late rows (I5)."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratus.operators import batched, latest, metrics
from stratus.sources import files, registry
from stratus.sources.sinks import Sink
from stratus.sources.streams import Source, read_stream
from stratus.streaming import counters, live, lookups, polls
from stratus.streaming import requests as sr
from stratus.streaming.versions import Versions, read_newest

NOW = {"availableNow": True}
CHANGE_DDL = "op string, seq bigint, id string, name string, country string, lat double, lon double, active boolean"


def _lines(path, lines, name="part-0.json"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _cities(spark, root, *names):
    ops = [("create", i, None, n, "FR", 1.0, 2.0, True) for i, n in enumerate(names)]
    return registry.apply_batch(spark, root, spark.createDataFrame(ops, CHANGE_DDL), root)


# --- registry on the stream -----------------------------------------------------
def test_a_registry_change_counts_from_the_next_batch(spark, tmp):
    root, sink = f"{tmp}/reg", Sink("json", path=f"{tmp}/out")
    _cities(spark, root, "Paris")
    asked = [json.dumps({"city_id": c}) for c in (" Paris-FR ", "lyon-fr")] + [json.dumps({"x": 1}), "nope"]

    def run(k):
        _lines(f"{tmp}/in", asked, f"p{k}.json")
        stream = lookups.parse_lookups(read_stream(spark, Source("files", path=f"{tmp}/in")))
        _run(lookups.start_lookup(stream, root, sink, f"{tmp}/ckpt", NOW))

    run(0)
    ops = [("toggle", 1, "paris-fr", None, None, None, None, None), ("create", 2, None, "Lyon", "fr", 3.0, 4.0, True)]
    registry.apply_batch(spark, root, spark.createDataFrame(ops, CHANGE_DDL), root)
    run(1)
    found = spark.read.json(f"{tmp}/out/found").select("batch", "city_id", "name")
    assert rows(found) == [(0, "paris-fr", "Paris"), (1, "lyon-fr", "Lyon")]
    unknown = spark.read.json(f"{tmp}/out/unknown").select("batch", "city_id", "error")
    assert rows(unknown) == [(0, "", lookups.NOT_FOUND), (0, "", lookups.NOT_FOUND), (0, "lyon-fr", lookups.NOT_FOUND),
                             (1, "", lookups.NOT_FOUND), (1, "", lookups.NOT_FOUND), (1, "paris-fr", lookups.NOT_FOUND)]


def test_replies_get_the_names_of_the_moment(spark, tmp):
    root, sink = f"{tmp}/reg", Sink("text", path=f"{tmp}/out")
    _cities(spark, root, "Paris")
    ddl = ("city_id string, ingested_at string, hourly struct<time:array<string>,temperature_2m:array<double>,"
           "relative_humidity_2m:array<double>,wind_speed_10m:array<double>>")
    reply = {"city_id": "paris-fr", "ingested_at": "2025-01-01T00:00:00Z",
             "hourly": {"time": ["2025-01-01T00:00"], "temperature_2m": [1.0]}}
    sink_json = Sink("json", path=f"{tmp}/out")
    for k in range(2):
        _lines(f"{tmp}/in", [json.dumps(reply), json.dumps({**reply, "city_id": "ghost"})], f"p{k}.json")
        stream = spark.readStream.schema(ddl).json(f"{tmp}/in")
        _run(lookups.start_envelopes(stream, root, sink_json, f"{tmp}/ckpt", NOW))
        registry.apply_batch(spark, root, spark.createDataFrame(
            [("update", 1, "paris-fr", "Paname", "FR", 1.0, 2.0, True)], CHANGE_DDL), root)
    events = lookups.read_step(spark, sink_json, "events", "value string")
    names = sorted(json.loads(r.value)["_meta"]["city_name"] for r in events.collect())
    assert names == ["Paname", "Paris"]
    assert lookups.read_step(spark, sink, "unknown", "value string").count() == 2


# --- requests that fail while they run -----------------------------------------
def _stats(spark, n=12):
    t = dt.datetime(2024, 1, 1)
    return batched.daily_stats(spark.createDataFrame(
        [(f"c{i}", "A", "EU", t, float(i), 1.0, 2.0, dt.date(2024, 1, 1)) for i in range(n)],
        "city_id string, city_name string, country string, hour_ts timestamp, temperature_2m double, "
        "relative_humidity_2m double, wind_speed_10m double, date date"))


def _failing(bad):
    def answer(stats, requests):
        fails = F.when(F.col("request_id").isin(*bad), F.raise_error(F.concat(F.lit("no answer for "), F.col("request_id")))
                       .cast("array<string>"))
        return batched.batched_from_stats(stats, requests.withColumn("city_ids", F.coalesce(fails, "city_ids")))
    return answer


def _requests(spark, n=12):
    return spark.createDataFrame([(f"r{i}", [f"c{i}"], None, None, ["temperature_2m"], "max") for i in range(n)]
                                 + [("sum", ["c1"], None, None, ["temperature_2m"], "sum")],
                                 "request_id string, city_ids array<string>, date_from string, date_to string, "
                                 "metrics array<string>, agg string")


def test_failing_requests_do_not_take_the_others_with_them(spark, tmp):
    asked, stats = _requests(spark), _stats(spark)
    for attempt in range(2):  # the second is a replay
        sr.answer_batch(asked, stats, f"{tmp}/res", f"{tmp}/status", 0, answer=_failing(["r3", "r8"]))
        log = files.read_statuses(spark, f"{tmp}/status")
        last = {r.request_id: r for r in latest.latest_status(log, order_by=("log_offset",)).collect()}
        assert {i: r.status for i, r in last.items()} == {
            **{f"r{i}": "error" if i in (3, 8) else "success" for i in range(12)}, "sum": "error"}
        assert "no answer for r3" in last["r3"].error and last["sum"].error == "invalid agg: sum"
        assert last["r3"].result_path is None
        for i in (0, 5, 11):
            assert rows(sr.read_answer(spark, log, f"r{i}"), "city_id", "value") == [(f"c{i}", float(i))]
        assert sr.read_answer(spark, log, "r8") is None
        assert spark.read.parquet(f"{tmp}/res").count() == 10
    # The fault is gone at a later replay: one folder again, nothing left of the parts.
    sr.answer_batch(asked, stats, f"{tmp}/res", f"{tmp}/status", 0)
    assert os.listdir(f"{tmp}/res/batch=0") == ["part=all"]
    log = files.read_statuses(spark, f"{tmp}/status")
    assert latest.latest_status(log, order_by=("log_offset",)).where("status = 'success'").count() == 12


def test_answers_beside_failing_requests_are_written_in_one_job(spark, tmp):
    calls = []

    def answer(stats, requests):
        calls.append(1)
        return _failing(["r3"])(stats, requests)

    folder, bad = sr.answer_isolated(_requests(spark), _stats(spark), f"{tmp}/res", answer)
    assert os.listdir(f"{tmp}/res") == ["part=all"] and folder == f"{tmp}/res/part=all"
    assert bad.keys() == {"r3"} and "no answer for r3" in bad["r3"]
    assert spark.read.parquet(folder).count() == 11
    assert len(calls) <= 2 + 13 + 4  # the batch twice, its parts


def test_a_fault_of_everything_fails_the_batch(spark, tmp, monkeypatch):
    monkeypatch.setattr(sr, "MAX_FAILURES", 6)
    with pytest.raises(Exception, match="no answer for"):
        sr.answer_batch(_requests(spark), _stats(spark), f"{tmp}/res", f"{tmp}/status", 0,
                        answer=_failing([f"r{i}" for i in range(12)]))
    assert not os.path.exists(f"{tmp}/status/batch=0/step=2")


def test_the_last_request_in_the_file_counts(spark, tmp):
    """One id asked twice, and requests without one, from files."""
    _lines(f"{tmp}/in", [json.dumps({"request_id": "x", "city_ids": ["c9"]}), json.dumps({"request_id": "x", "city_ids": ["c2"]}),
                         json.dumps({"city_ids": ["c5"]}), json.dumps({"request_id": "", "city_ids": ["c4"]})])
    raw = read_stream(spark, Source("files", path=f"{tmp}/in"), ordered=True)
    _run(sr.start_requests(raw, _stats(spark), f"{tmp}/res", f"{tmp}/status", f"{tmp}/ckpt", NOW))
    assert rows(spark.read.parquet(f"{tmp}/res"), "request_id", "city_id") == [("no-request-id", "c4"), ("x", "c2")]


# --- counters and sums -----------------------------------------------------------
def _each_run(spark, tmp, parts, ddl, start):
    for k, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        _run(start(spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(f"{tmp}/in")))
        yield k


def test_counters_go_on_after_a_restart_and_never_fall(spark, tmp):
    ddl = "kind string, reason string, sec double"
    parts = [[("a", None, 0.2), ("a", "E1", 3.0), (None, "E1", 1.0)], [("a", None, 0.001), ("b", "E2", 1.0)],
             [("a", "E1", 1.0), (None, "E1", 2.0)]]
    seen, before = [], {}
    for k in _each_run(spark, tmp, parts, ddl, lambda s: counters.start_failures(
            s, f"{tmp}/out", f"{tmp}/ckpt", trigger=NOW)):
        seen += parts[k]
        now = {(r.kind, r.reason): r.failures for r in read_newest(spark, f"{tmp}/out").collect()}
        whole = metrics.failures_by_reason(spark.createDataFrame(seen, ddl))
        assert now == {(r.kind, r.reason): r.failures for r in whole.collect()}
        assert all(now[x] >= n for x, n in before.items())
        before = now
    assert len(Versions(spark, f"{tmp}/out").ids()) == 2


def test_sums_follow_the_newest_sample_of_each_series(spark, tmp):
    ddl = "grp string, part long, ts timestamp, seq long, value double"
    t = [dt.datetime(2025, 1, 1, 0, m) for m in range(6)]
    parts = [[("g", 1, t[2], 1, 10.0), ("g", 2, t[1], 2, 5.0), (None, 1, t[1], 3, 7.0), ("h", 1, t[0], 4, None)],
             [("g", 1, t[1], 5, 99.0), ("g", 2, t[1], 6, 6.0)],          # older; same time, later in order
             [("g", 1, t[3], 7, -1.5), ("h", 1, t[4], 8, 2.0), ("g", 3, None, 9, 4.0)],
             [("g", 2, t[5], 10, None)]]                                  # a series that has no number any more
    seen = []
    for k in _each_run(spark, tmp, parts, ddl, lambda s: counters.start_sum_latest(
            s, ["grp", "part"], ["grp"], f"{tmp}/out", f"{tmp}/ckpt", NOW)):
        seen += parts[k]
        whole = metrics.sum_latest(spark.createDataFrame(seen, ddl), ["grp", "part"], ["grp"])
        want = {r.grp: r.value or 0.0 for r in whole.collect()}
        got = {r.grp: r.value for r in read_newest(spark, f"{tmp}/out").collect()}
        assert got == pytest.approx(want), k
    assert {r.grp: r.series for r in read_newest(spark, f"{tmp}/out").collect()} == {"g": 3, "h": 1, None: 1}


def test_sums_without_labels_and_labels_that_no_series_has(spark, tmp):
    ddl = "part long, ts timestamp, seq long, value double"
    parts = [[(i, dt.datetime(2025, 1, 1), i, 1.0) for i in range(20)], [(3, dt.datetime(2025, 1, 2), 1, 0.0)]]
    for _ in _each_run(spark, tmp, parts, ddl, lambda s: counters.start_sum_latest(
            s, ["part"], [], f"{tmp}/out", f"{tmp}/ckpt", NOW)):
        pass
    assert rows(read_newest(spark, f"{tmp}/out")) == [(19.0, 20)]
    with pytest.raises(ValueError, match="labels"):
        counters.moves(spark.createDataFrame(parts[0], ddl), ["part"], ["grp"])


def test_a_replayed_batch_builds_on_the_same_predecessor(spark, tmp):
    table = Versions(spark, f"{tmp}/t")
    for k in range(4):
        table.write(spark.range(k + 1), k)
    assert table.ids() == [2, 3] and table.read(before=3).count() == 3
    table.write(spark.range(9), 3)
    assert table.read(before=3).count() == 3 and table.read().count() == 9
    os.remove(f"{tmp}/t/batch=3/_SUCCESS")  # half-written: readers stay with the one before
    assert read_newest(spark, f"{tmp}/t").count() == 3


def test_poll_counters_are_written_once_per_batch(spark, tmp):
    ddl = "poll long, has_current boolean"
    listener = polls.PollListener(spark, f"{tmp}/polls")
    spark.streams.addListener(listener)
    try:
        for k in range(2):
            spark.createDataFrame([(k, i > 0) for i in range(3)], ddl).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
            s = polls.observed(spark.readStream.schema(ddl).parquet(f"{tmp}/in"))
            q = (s.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck")
                 .trigger(**NOW).start())
            polls.await_polls(q, spark, f"{tmp}/polls")
    finally:
        spark.streams.removeListener(listener)
    got = polls.read_polls(spark, f"{tmp}/polls").drop("observed_at")
    assert rows(got) == [(0, 0, 5, 3), (1, 1, 5, 3)]


# --- late rows -----------------------------------------------------------------
def test_late_rows_are_kept_and_folded(spark, tmp):
    ddl = "ts timestamp, city_name string"
    t0 = dt.datetime(2025, 1, 1)
    at = lambda m, s=0: t0 + dt.timedelta(minutes=m, seconds=s)
    parts = [[(at(0, 5), "A"), (at(1), "A"), (at(30), "A")], [(at(0, 50), "A"), (at(29), "B"), (at(31), "A"), (None, "A")],
             [(at(2), "B"), (at(60), "B")], [(at(1, 59), "A")]]
    seen = []
    for k in _each_run(spark, tmp, parts, ddl, lambda s: live.start_whole_rate(
            s, f"{tmp}/out", f"{tmp}/ckpt", slide="30 seconds", trigger=NOW)):
        seen += parts[k]
        whole = metrics.event_rate(spark.createDataFrame(seen, ddl), slide="30 seconds")
        assert rows(live.read_rates(spark, f"{tmp}/out").drop("late_n")) == rows(whole)
        live.compact_rates(spark, f"{tmp}/out")
        assert rows(live.read_rates(spark, f"{tmp}/out").drop("late_n")) == rows(whole)
    assert sorted(os.listdir(f"{tmp}/out/counts")) == ["batch=3", "to=2"]
    late = spark.read.parquet(f"{tmp}/out/late")
    assert rows(late, "ts") == [(at(0, 50),), (at(1, 59),), (at(2),)]
    closed = live.read_rates(spark, f"{tmp}/out", closed_only=True)
    assert closed.where(F.col("window_start") >= F.lit(at(57, 30))).count() == 0
    assert closed.agg(F.sum("late_n")).first()[0] == 6  # three rows in two windows each


# --- inputs are built once ---------------------------------------------------------
@pytest.mark.parametrize("query", ["q_stream_city_events", "q_stream_poll_counters"])
def test_the_input_of_a_counting_stream_is_built_once(spark, tmp, monkeypatch, query):
    from stratus.plans import stream_catalog

    made = spark.sparkContext.accumulator(0)

    @F.udf("double", useArrow=False)
    def value(x):
        made.add(1)
        return x

    ddl = ("city_id string, city_name string, country string, hour_ts timestamp, temperature_2m double, "
           "relative_humidity_2m double, wind_speed_10m double, date date, fetch_seq long")
    t = dt.datetime(2025, 1, 1)
    hourly = spark.createDataFrame(
        [(f"c{i % 3}", "n", "EU", t, float(i), 1.0, 2.0, t.date(), 24 * i) for i in range(12)], ddl).coalesce(1)
    monkeypatch.setattr(stream_catalog.V, "hourly", lambda *_: hourly.withColumn("temperature_2m", value("temperature_2m")))
    monkeypatch.setattr(stream_catalog, "_dirs", lambda *_: f"{tmp}/streams")
    got = getattr(stream_catalog, query)(spark, "")
    total = "cities" if "poll" in query else "events"
    assert got.agg(F.sum(total)).first()[0] == 12
    assert made.value == 12


def test_only_series_with_a_newer_sample_move(spark):
    ddl = "part long, ts timestamp, seq long, value double"
    t = dt.datetime(2025, 1, 1)
    held = counters.newest(spark.createDataFrame([(1, t, 1, 1.0), (None, t, 2, 5.0), (3, t, 3, None)], ddl), ["part"])
    later = spark.createDataFrame([(1, t, 1, 9.0), (None, t, 3, 6.0), (3, t, 2, 4.0), (2, t, 1, 1.0), (2, t, 0, 8.0)], ddl)
    moved = counters.moves(later, ["part"], [], held)
    assert rows(moved, "part", "old", "new", "added") == [(None, 5.0, 6.0, 0), (2, None, 1.0, 1)]
