"""Current observation with fallback."""

from conftest import raw_event

from stratus.operators.current import current_flat, current_values


def _df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_current_values_win(spark):
    ev = raw_event(current={"time": "x", "temperature_2m": 10.0, "relative_humidity_2m": 50.0,
                            "wind_speed_10m": 2.0})
    r = current_flat(_df(spark, [ev])).collect()[0]
    assert (r.temperature_c, r.humidity_pct, r.wind_ms) == (10.0, 50.0, 2.0)
    assert r.source == "open-meteo" and r.ts == "2025-01-01T00:30:00Z"


def test_fallback_to_last_hourly_element(spark):
    ev = raw_event(current={"temperature_2m": None, "relative_humidity_2m": 55.0})
    r = current_flat(_df(spark, [ev])).collect()[0]
    assert (r.temperature_c, r.humidity_pct, r.wind_ms) == (2.5, 55.0, 4.0)


def test_bad_last_element_is_null_but_others_survive(spark):
    ev = raw_event(temps=[1.0, "abc"], current=None)
    r = current_flat(_df(spark, [ev])).collect()[0]
    assert r.temperature_c is None and r.humidity_pct == 81.0


def test_no_value_at_all_drops_the_event(spark):
    ev = raw_event(times=[], temps=[], hums=[], winds=[], current=None)
    df = _df(spark, [ev])
    assert current_flat(df).count() == 0
    assert [r.has_current for r in current_values(df).collect()] == [False]
