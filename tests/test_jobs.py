"""The command-line jobs, end to end on files: raw -> bronze -> gold ->
query result; request service -> statuses -> status lookup."""

import json
import os

from conftest import raw_event

from stratus.jobs import daily, hourly_stream, request_stream, run_query, status


def _lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_jobs_end_to_end(spark, tmp, capsys):
    _lines(f"{tmp}/raw", [raw_event(city="a", temps=[1.0, 5.0]),
                          raw_event(city="b", name="B", temps=[2.0, 4.0])])
    assert hourly_stream.main([
        "--source", "files", "--raw-path", f"{tmp}/raw", "--bronze", f"{tmp}/bronze",
        "--partition-by-date", "--messages", f"{tmp}/msgs", "--checkpoint", f"{tmp}/ckpt",
        "--trigger", "once", "--max-per-trigger", "1", "--current", f"{tmp}/current"]) == 0
    assert spark.read.parquet(f"{tmp}/bronze").count() == 4
    assert sorted(r.temperature_c for r in spark.read.parquet(f"{tmp}/current").collect()) == [4.0, 5.0]

    assert daily.main(["--bronze", f"{tmp}/bronze", "--gold", f"{tmp}/gold",
                       "--stats", f"{tmp}/stats", "--check-day", "2025-01-01"]) == 0
    assert "rows=2 present=True" in capsys.readouterr().out
    # Incremental run over one day replaces only that day.
    assert daily.main(["--bronze", f"{tmp}/bronze", "--gold", f"{tmp}/gold",
                       "--date-from", "2025-01-01", "--date-to", "2025-01-01",
                       "--check-day", "2025-01-01"]) == 0
    assert spark.read.parquet(f"{tmp}/gold").count() == 2

    assert run_query.main(["--bronze", f"{tmp}/bronze", "--out-base", f"{tmp}/q",
                           "--request_id", "r1", "--city_ids", "a", "--metrics",
                           "temperature_2m,bogus", "--agg", "max"]) == 0
    res = spark.read.parquet(f"{tmp}/q/r1").collect()
    assert [(r.city_id, r.max_temperature_2m) for r in res] == [("a", 5.0)]
    assert run_query.main(["--bronze", f"{tmp}/bronze", "--out-base", f"{tmp}/q",
                           "--request_id", "r2", "--metrics", "bogus"]) == 2

    _lines(f"{tmp}/req", [json.dumps({"request_id": "x", "metrics": ["wind_speed_10m"]}),
                          json.dumps({"request_id": "y", "agg": "median"})])
    assert request_stream.main(["--source", "files", "--requests", f"{tmp}/req",
                                "--stats", f"{tmp}/stats", "--results", f"{tmp}/res",
                                "--status", f"{tmp}/status", "--checkpoint", f"{tmp}/ck2",
                                "--once"]) == 0
    capsys.readouterr()
    for rid, word in (("x", "success"), ("y", "error"), ("z", "pending")):
        assert status.main(["--status", f"{tmp}/status", "--request_id", rid]) == 0
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == word


def test_registry_job(spark, tmp):
    from stratus.jobs import registry
    doc = {"version": 5, "updated_at": "2025-09-25T12:26:15Z", "updated_by": "x", "cities": [
        {"id": "paris-fr", "name": "Paris", "country": "FR", "lat": 48.8566, "lon": 2.3522, "active": True},
        {"id": "lyon-fr", "name": "Lyon", "country": "FR", "lat": 45.764, "lon": 4.8357, "active": True}]}
    with open(f"{tmp}/cities.json", "w") as f:
        json.dump(doc, f)
    changes = [
        {"op": "create", "seq": 1, "name": "Saint Étienne", "country": "fr", "lat": 45.4, "lon": 4.4},
        {"op": "create", "seq": 2, "name": "Nowhere", "country": "FR", "lat": 99.0, "lon": 0.0},
        {"op": "update", "seq": 3, "id": "paris-fr", "name": "Paris", "country": "FR",
         "lat": 48.0, "lon": 2.0, "active": True},
        {"op": "update", "seq": 4, "id": "ghost", "name": "G", "country": "FR", "lat": 0.0, "lon": 0.0},
        {"op": "toggle", "seq": 5, "id": "lyon-fr"},
        {"op": "delete", "seq": 6, "id": "ghost2"},
    ]
    _lines(f"{tmp}/changes", [json.dumps(c) for c in changes])
    assert registry.main(["--registry", f"{tmp}/cities.json", "--changes", f"{tmp}/changes",
                          "--out-root", f"{tmp}/reg", "--user", "tests", "--log", f"{tmp}/log",
                          "--rejected", f"{tmp}/rej"]) == 0
    reg = {r.id: r for r in spark.read.json(f"{tmp}/reg/v=8").collect()}
    assert set(reg) == {"paris-fr", "lyon-fr", "saint-tienne-fr"}
    assert reg["paris-fr"].lat == 48.0 and reg["lyon-fr"].active is False
    assert reg["saint-tienne-fr"].country == "FR"
    log = {r.seq: r.version for r in spark.read.json(f"{tmp}/log").collect()}
    assert log == {1: 6, 3: 7, 5: 8}
    rej = {r.id: r.error for r in spark.read.json(f"{tmp}/rej").collect()}
    assert rej == {"nowhere-fr": "invalid: lat_range", "ghost": "city not found",
                   "ghost2": "city not found"}


def test_live_job(spark, tmp):
    from stratus.jobs import live
    msgs = [
        {"key": "a|2025010100", "value": json.dumps({"city_id": "a", "city_name": "A", "country": "FR",
                                                     "hour_ts": "2025-01-01T00:00:00Z", "temperature_2m": 1.0})},
        {"key": "a|2025010101", "value": json.dumps({"city_id": "a", "city_name": "A", "country": "FR",
                                                     "hour_ts": "2025-01-01T01:00:00Z", "wind_speed_10m": 3.0})},
    ]
    _lines(f"{tmp}/msgs", [json.dumps(m) for m in msgs])
    cur = [{"city_id": "a", "city_name": "A", "country": "FR", "ts": f"2025-01-01T00:0{i}:00Z",
            "temperature_c": 1.0} for i in range(3)]
    cur.append({"city_id": "a", "city_name": "A", "country": "FR", "ts": "2025-01-01T01:00:00Z"})
    _lines(f"{tmp}/cur", [json.dumps(c) for c in cur])
    assert live.main(["--source", "files", "--messages", f"{tmp}/msgs", "--latest-out", f"{tmp}/latest",
                      "--current", f"{tmp}/cur", "--rate-out", f"{tmp}/rate",
                      "--checkpoint", f"{tmp}/ckpt", "--once"]) == 0
    r = spark.read.parquet(f"{tmp}/latest").collect()
    assert [(x.city_id, x.temperature_2m, x.wind_speed_10m) for x in r] == [("a", 1.0, 3.0)]
    rates = spark.read.parquet(f"{tmp}/rate").collect()
    assert len(rates) == 3 and all(x.rate == 1 / 60 for x in rates)


def test_stream_last_fetch(spark, tmp):
    import datetime as dt
    from stratus.streaming.live import live_last_fetch
    rows_ = [{"city_id": "a", "hour_ts": "2025-01-01T00:00:00Z", "t": float(i),
              "ingested_at": f"2025-01-01T00:0{i}:00Z"} for i in range(3)]
    rows_.append({"city_id": "a", "hour_ts": "2025-01-05T00:00:00Z", "t": 9.0,
                  "ingested_at": "2025-01-05T00:00:00Z"})
    _lines(f"{tmp}/in", [json.dumps(x) for x in rows_])
    s = spark.readStream.schema("city_id string, hour_ts timestamp, t double, ingested_at string").json(f"{tmp}/in")
    q = (live_last_fetch(s, watermark="1 day").writeStream.outputMode("append").format("parquet")
         .option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp}/out").collect()
    assert [(x.hour_ts, x.t) for x in out] == [(dt.datetime(2025, 1, 1), 2.0)]   # later hour still open
