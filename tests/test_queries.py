"""A3 A6 A7 A17 C1-C3 B5 E1 E2 G1 H16-H19 D4, P3 P5 P8 P13."""

import datetime as dt

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from stratus.operators import batched, daily, paramquery
from stratus.operators.paramquery import RequestError, resolve

BRONZE = (
    "city_id string, city_name string, country string, hour_ts timestamp, "
    "temperature_2m double, relative_humidity_2m double, wind_speed_10m double, date date"
)


def _bronze(spark):
    data = []
    for ci, city in enumerate(["a", "b", "c"]):
        for day in range(1, 6):
            for h in range(3):
                t = None if (ci + day + h) % 7 == 0 else float(ci * 10 + day + h)
                data.append((city, city.upper(), "EU", dt.datetime(2024, 1, day, h), t,
                             float(50 + h), float(day) / 2, dt.date(2024, 1, day)))
    return spark.createDataFrame(data, BRONZE)


def test_resolve_defaults():
    p = resolve({})
    assert p.request_id == "no-request-id" and p.metrics == ("temperature_2m",)
    assert p.agg == "avg" and p.city_ids == () and p.date_from is None


def test_resolve_lists_and_case():
    p = resolve(city_ids=[" a", "", "b,c "], metrics=["wind_speed_10m", "bogus",
                "wind_speed_10m", "temperature_2m"], agg="MAX", date_from="2024-01-02")
    assert p.city_ids == ("a", "b", "c")
    assert p.metrics == ("wind_speed_10m", "temperature_2m")
    assert p.agg == "max" and p.date_from == dt.date(2024, 1, 2)
    assert p.columns == ["max_wind_speed_10m", "max_temperature_2m"]
    q = resolve(city_ids="a, b", metrics="relative_humidity_2m, bogus")   # CSV text form
    assert q.city_ids == ("a", "b") and q.metrics == ("relative_humidity_2m",)


@pytest.mark.parametrize("conf", [
    {"agg": "sum"}, {"metrics": ["bogus"]}, {"date_from": "bad"}, {"date_to": "2024-13-01"},
])
def test_resolve_errors(conf):
    with pytest.raises(RequestError):
        resolve(conf)


def test_param_query_filters_and_columns(spark):
    b = _bronze(spark)
    p = resolve(city_ids=["a", "c"], date_from="2024-01-02", date_to="2024-01-03",
                metrics=["relative_humidity_2m", "temperature_2m"], agg="min")
    out = paramquery.param_query(b, p)
    assert out.columns == ["city_id", "city_name", "country", "date",
                           "min_relative_humidity_2m", "min_temperature_2m"]
    got = out.collect()
    assert [(r.city_id, r.date.day) for r in got] == [("a", 2), ("a", 3), ("c", 2), ("c", 3)]
    assert all(r.min_relative_humidity_2m == 50.0 for r in got)


def test_param_query_from_after_to_is_empty(spark):
    p = resolve(date_from="2024-01-05", date_to="2024-01-01")
    assert paramquery.param_query(_bronze(spark), p).count() == 0


def test_param_query_pushes_filters_to_scan(spark, tmp):
    _bronze(spark).write.partitionBy("date").parquet(tmp + "/b")
    b = spark.read.parquet(tmp + "/b")
    p = resolve(city_ids=["a"], date_from="2024-01-02", date_to="2024-01-03")
    plan = paramquery.param_query(b, p)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    # A one-element IN is rewritten to equality; either way it reaches the scan.
    assert "PushedFilters: [IsNotNull(city_id), EqualTo(city_id,a)]" in plan


def test_write_result_is_sorted(spark, tmp):
    p = resolve()
    out = paramquery.param_query(_bronze(spark), p, ordered=False)
    for single in (True, False):
        path = f"{tmp}/r{single}"
        paramquery.write_result(out, path, single_file=single)
        back = spark.read.parquet(path).collect()
        keys = [(r.city_id, r.date) for r in back]
        assert keys == sorted(keys) and len(keys) == 15


def test_daily_aggregate_and_guard(spark):
    b = _bronze(spark)
    d = daily.daily_aggregate(b)
    assert d.count() == 15
    r = d.where("city_id = 'a' AND date = DATE'2024-01-01'").collect()[0]
    assert (r.min_temperature_2m, r.max_temperature_2m, r.avg_relative_humidity_2m) == (1.0, 3.0, 51.0)
    with pytest.raises(daily.MissingColumns, match="wind_speed_10m"):
        daily.daily_aggregate(b.drop("wind_speed_10m"))


def test_write_daily_full_vs_dynamic(spark, tmp):
    d = daily.daily_aggregate(_bronze(spark))
    part = d.where("date = DATE'2024-01-03'")
    for mode, expected in (("full", 3), ("dynamic", 15)):
        path = f"{tmp}/{mode}"
        daily.write_daily(d, path)
        daily.write_daily(part, path, mode=mode)
        assert spark.read.parquet(path).count() == expected
    gold = spark.read.parquet(f"{tmp}/dynamic")
    assert rows(daily.partition_presence(gold, "2024-01-03")) == [(dt.date(2024, 1, 3), 3, True)]
    assert rows(daily.partition_presence(gold, "2023-01-03")) == [(dt.date(2023, 1, 3), 0, False)]


REQ_DDL = ("request_id string, city_ids array<string>, date_from string, date_to string, "
           "metrics array<string>, agg string")


def test_batched_errors_and_defaults(spark):
    req = spark.createDataFrame([
        ("ok", None, None, None, None, None),
        ("bad-agg", [], None, None, ["temperature_2m"], "sum"),
        ("bad-metric", [], None, None, ["bogus"], "avg"),
        ("bad-date", [], "bad", None, None, "avg"),
        (None, ["a"], None, None, [], "AVG"),
    ], REQ_DDL)
    errs = dict(rows(batched.request_errors(req)))
    assert set(errs) == {"bad-agg", "bad-metric", "bad-date"}
    n = batched.normalize_requests(req).where("error IS NULL").collect()
    assert sorted(r.request_id for r in n) == ["no-request-id", "ok"]
    assert all(r.metrics == ["temperature_2m"] and r.agg == "avg" for r in n)


ids = st.lists(st.sampled_from(["a", "b", "c", "zz"]), max_size=3)
days = st.one_of(st.none(), st.integers(1, 6).map(lambda d: f"2024-01-0{d}"))
mets = st.lists(st.sampled_from(["temperature_2m", "relative_humidity_2m", "wind_speed_10m",
                                 "bogus"]), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None)
@given(reqs=st.lists(st.tuples(ids, days, days, mets, st.sampled_from(["avg", "min", "max"])),
                     min_size=1, max_size=4))
def test_batched_equals_single_runs(spark, reqs):
    """D4 property: N requests in one job == N single runs."""
    b = _bronze(spark)
    rows_in = [(f"r{i}", c, f, t, m, a) for i, (c, f, t, m, a) in enumerate(reqs)]
    req = spark.createDataFrame(rows_in, REQ_DDL)
    long = batched.batched_query(b, req)
    for rid, c, f, t, m, a in rows_in:
        try:
            p = resolve(request_id=rid, city_ids=c, date_from=f, date_to=t, metrics=m, agg=a)
        except RequestError:
            assert long.where(f"request_id = '{rid}'").count() == 0
            continue
        single = paramquery.param_query(b, p, ordered=False)
        wide = batched.to_wide(long, rid, list(p.metrics), p.agg)
        assert rows(wide) == rows(single)
