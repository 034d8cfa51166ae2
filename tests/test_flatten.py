"""Raw event -> hourly rows."""

import datetime as dt
import json

from conftest import raw_event, rows

from stratus.operators import envelope, flatten


def _df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_full_event(spark):
    out = flatten.flatten(_df(spark, [raw_event()]))
    assert out.columns == ["city_id", "city_name", "country", "hour_ts", "temperature_2m",
                           "relative_humidity_2m", "wind_speed_10m", "date"]
    got = rows(out)
    assert got == [
        ("paris-fr", "Paris", "FR", dt.datetime(2025, 1, 1, 0, 0), 1.5, 80.0, 3.0, dt.date(2025, 1, 1)),
        ("paris-fr", "Paris", "FR", dt.datetime(2025, 1, 1, 1, 0), 2.5, 81.0, 4.0, dt.date(2025, 1, 1)),
    ]


def test_short_array_is_padded(spark):
    out = flatten.flatten(_df(spark, [raw_event(temps=[1.5])]))
    assert rows(out, "temperature_2m", "wind_speed_10m") == [(None, 4.0), (1.5, 3.0)]


def test_missing_null_or_bad_arrays_drop_the_event(spark):
    bad = [
        raw_event(drop=("wind_speed_10m",)),                     # missing array
        raw_event(winds=None, raw={"hourly": {"time": ["2025-01-01T00:00"],
                                              "temperature_2m": [1.0],
                                              "relative_humidity_2m": [1.0],
                                              "wind_speed_10m": None}}),   # null array
        raw_event(temps=[1.0, "abc"]),                            # one bad element
        raw_event(raw={"hourly": {"time": "2025-01-01T00:00", "temperature_2m": 1.0,
                                  "relative_humidity_2m": 1.0, "wind_speed_10m": 1.0}}),
        "nope",
        "{}",
    ]
    df = _df(spark, bad)
    assert flatten.flatten(df).count() == 0
    assert flatten.quarantined(df).count() == len(bad)


def test_unparseable_time_gives_null_hour(spark):
    out = flatten.flatten(_df(spark, [raw_event(times=["xx", "2025-01-01T01:00"])]))
    assert sorted((r.hour_ts is None, r.date is None) for r in out.collect()) == [
        (False, False), (True, True)]


def test_same_event_twice_gives_rows_twice(spark):
    # No de-duplication by default.
    assert flatten.flatten(_df(spark, [raw_event(), raw_event()])).count() == 4


def test_only_raw_hourly_is_read(spark):
    # The flatten reads raw.hourly, not the top-level hourly copy.
    ev = json.loads(raw_event())
    ev["hourly"]["temperature_2m"] = [99.0, 99.0]
    out = flatten.flatten(_df(spark, [json.dumps(ev)]))
    assert rows(out, "temperature_2m") == [(1.5,), (2.5,)]


def test_keep_ingested_at(spark):
    out = flatten.flatten(_df(spark, [raw_event()]), keep_ingested_at=True)
    assert {r.ingested_at for r in out.collect()} == {"2025-01-01T00:30:00Z"}


def test_hourly_payload_key_and_json(spark):
    b = flatten.flatten(_df(spark, [raw_event(temps=[None, 2.5])]))
    p = flatten.hourly_payload(b).collect()
    by_key = {r.key: json.loads(r.value) for r in p}
    assert set(by_key) == {"paris-fr|2025010100", "paris-fr|2025010101"}
    first = by_key["paris-fr|2025010100"]
    assert first["hour_ts"] == "2025-01-01T00:00:00Z"
    assert "temperature_2m" not in first        # null fields left out (P6)
    assert "date" not in first
    assert by_key["paris-fr|2025010101"]["temperature_2m"] == 2.5


def test_key_skips_null_parts(spark):
    # concat_ws skips NULLs: a NULL hour gives just the city id.
    b = flatten.flatten(_df(spark, [raw_event(times=["bad", "2025-01-01T01:00"])]))
    keys = sorted(r.key for r in flatten.hourly_payload(b).collect())
    assert keys == ["paris-fr", "paris-fr|2025010101"]


def test_envelope_round_trip(spark):
    """hourly -> replies -> envelope -> flatten gives the hourly rows back."""
    h = spark.createDataFrame(
        [("c1", "A", "EU", dt.datetime(2024, 1, 1, h % 24), float(h), None, h / 10, dt.date(2024, 1, 1), h)
         for h in range(60)],
        "city_id string, city_name string, country string, hour_ts timestamp, "
        "temperature_2m double, relative_humidity_2m double, wind_speed_10m double, date date, "
        "fetch_seq bigint",
    )
    env = envelope.envelope(envelope.replies_from_hourly(h, block=24))
    assert env.count() == 3                  # blocks of at most 24 fetches
    back = flatten.flatten(env)
    cols = [c for c in h.columns if c != "fetch_seq"]
    assert back.exceptAll(h.select(cols)).count() == 0
    assert h.select(cols).exceptAll(back).count() == 0


def test_observed_counters(spark):
    from pyspark.sql import Observation
    obs = Observation("flatten")
    out = flatten.flatten(_df(spark, [raw_event(), raw_event(drop=("time",)), "nope"]), observe=obs)
    assert out.count() == 2
    assert obs.get == {"events": 3, "dropped_events": 2, "hourly_rows": 2}


def test_filters_do_not_parse_the_event_again(spark):
    """One from_json per event, below what filters on its fields and the generated rows."""
    from stratus.operators import current

    df = spark.createDataFrame([("{}",)], "value string")
    for out in (flatten.flatten(df).where("city_id <> ''"), current.current_flat(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_day_events_are_spread_over_all_cores(spark):
    from stratus.plans import views

    spread = views._spread(spark.range(10).coalesce(1), "id")
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
