"""Scale guards on the physical plans of the catalogue queries."""

import pytest
from conftest import SF_SMALL

from stratus.plans import catalog

BATCH = sorted(n for n in catalog.QUERIES if not n.startswith("stream_"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


def test_aggregates_are_two_phase(spark):
    """Every aggregate folds rows per task before the shuffle (``partial_``)."""
    for name in ("daily_weather", "latest_by_city", "hourly_dedup", "event_rate_1m",
                 "status_rollup", "sum_latest_by_labels", "param_all_cities_open_range"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "partial_" in plan, name


def test_plain_aggregates_use_hash_aggregation(spark):
    # Fixed-width buffers -> HashAggregate; so does ``max_by`` of a number with
    # its composite ordering packed into one decimal.
    for name in ("daily_weather", "event_rate_1m", "param_avg", "latest_by_city", "sum_latest_by_labels",
                 "targets_up"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "SortAggregate" not in plan and "HashAggregate" in plan, name


def test_flatten_has_no_shuffle(spark, tmp):
    from stratus.operators.flatten import flatten
    df = spark.read.schema("value string").text(tmp)
    assert "Exchange" not in _plan(flatten(df))


def test_only_spec_bounded_tables_are_hinted(spark):
    # nation and region are the only explicit broadcasts in the views.
    plan = catalog.QUERIES["daily_weather"](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert plan.count("ResolvedHint (strategy=broadcast)") == 2


def _spoiled_stats(spark, tmp, lo, hi):
    """Stored stats whose files outside the days from ``lo`` to ``hi`` cannot be read."""
    import glob
    import os

    from stratus.operators import batched
    from stratus.plans import views as V
    batched.write_stats(batched.daily_stats(V.bronze(spark, SF_SMALL)), f"{tmp}/stats")
    good = spark.read.parquet(f"{tmp}/stats")
    rows = good.where(f"date between '{lo}' and '{hi}'").collect()
    for path in glob.glob(f"{tmp}/stats/date=*/*.parquet"):
        day = os.path.basename(os.path.dirname(path)).removeprefix("date=")
        if not lo <= day <= hi:
            with open(path, "wb") as f:
                f.write(b"junk")
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    return spark.read.schema(good.schema).parquet(f"{tmp}/stats"), rows


def test_bounded_requests_read_only_their_days(spark, tmp):
    """Pruned when the query runs: files of other days are not opened, whether cities
    are listed or not, and no job runs while the query is built."""
    from stratus.operators import batched
    stats, rows = _spoiled_stats(spark, tmp, "2024-01-02", "2024-01-10")
    ddl = "request_id string, city_ids array<string>, date_from string, date_to string, metrics array<string>, agg string"
    asked = spark.createDataFrame([
        ("r1", ["c1", "c2"], "2024-01-02", "2024-01-10", ["temperature_2m"], "avg"),
        ("r2", [" "], "2024-01-05", "2024-01-06", ["wind_speed_10m"], "max"),
        ("r3", ["c1"], "2024-01-09", "2024-01-03", ["wind_speed_10m"], "max")], ddl)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building a query")
    out = batched.batched_from_stats(stats, asked)
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {(r.request_id, r.city_id, str(r.date), r.value) for r in out.collect()}
    days = {"r1": ("2024-01-02", "2024-01-10"), "r2": ("2024-01-05", "2024-01-06")}
    want = {("r1", r.city_id, str(r.date), r.avg) for r in rows
            if r.city_id in ("c1", "c2") and r.metric == "temperature_2m" and days["r1"][0] <= str(r.date) <= days["r1"][1]}
    want |= {("r2", r.city_id, str(r.date), r.max) for r in rows
             if r.metric == "wind_speed_10m" and days["r2"][0] <= str(r.date) <= days["r2"][1]}
    assert got == want and len(want) > 2


def test_presence_reads_no_row(spark, tmp):
    from stratus.operators import daily
    from stratus.plans import views as V
    from stratus.sources.files import stored_day_presence
    daily.write_daily(daily.daily_aggregate(V.bronze(spark, SF_SMALL)), f"{tmp}/gold")
    out = stored_day_presence(spark, f"{tmp}/gold", "2024-01-03")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan, plan
    n = spark.read.parquet(f"{tmp}/gold").where("date = '2024-01-03'").count()
    assert [(r.n_rows, r.present) for r in out.collect()] == [(n, n > 0)]
    assert stored_day_presence(spark, f"{tmp}/none", "2024-01-03").first().present is False
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_packed_order_equals_the_struct_order(spark):
    from pyspark.sql import functions as F

    from stratus.operators.latest import packed_order
    df = spark.createDataFrame(
        [(0, "2024-01-01 00:00:00", 5), (1, "2024-01-01 00:00:00", -(2 ** 63)), (2, None, 9), (3, None, None),
         (4, "9999-12-31 23:59:59", 2 ** 63 - 1), (5, "0001-01-01 00:00:00", 7), (6, "2024-01-01 00:00:00", 2 ** 63 - 1)],
        "k int, t string, s long").withColumn("t", F.col("t").cast("timestamp"))
    by = lambda c: [r.k for r in df.orderBy(c).select("k").collect()]
    assert by(packed_order(df, ("t", "s"))) == by(F.struct("t", "s"))
    text = df.withColumn("t", F.col("t").cast("string"))
    assert by(packed_order(df, ("s",))) == by(F.col("s"))
    assert "struct" in str(packed_order(text, ("t", "s")))
