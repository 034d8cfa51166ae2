"""One key holding a third of all rows: joins split the hot partition (AQE
skew join, on in the session defaults); aggregates fold it before the shuffle."""

from pyspark.sql import functions as F

from stratus.operators import daily, latest


def _skewed_events(spark, n=120_000):
    # user 7 owns every third event
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("user_id"),
        (F.col("id") % 97).cast("double").alias("value"),
    )


def _final_plan(df) -> str:
    """Run ``df`` itself (so its adaptive plan becomes final) and return it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_join_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",      # force a shuffle join
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = _skewed_events(spark)
        cities = spark.range(0, 1000).select(F.col("id").alias("city_key"),
                                             F.concat(F.lit("c"), F.col("id")).alias("city_id"))
        j = ev.join(cities, ev["user_id"] == cities["city_key"]).select("event_id")
        assert "skew=true" in _final_plan(j)
        assert j.count() == 120_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_aggregates_are_partial(spark):
    ev = _skewed_events(spark).select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("city_id"),
        F.lit("C").alias("city_name"), F.lit("EU").alias("country"),
        F.timestamp_seconds(F.col("event_id")).alias("hour_ts"),
        F.col("value").alias("temperature_2m"), F.col("value").alias("relative_humidity_2m"),
        F.col("value").alias("wind_speed_10m"),
        F.to_date(F.timestamp_seconds(F.col("event_id"))).alias("date"),
        F.col("event_id").alias("fetch_seq"),
    )
    for df in (daily.daily_aggregate(ev), latest.latest_by_city(ev)):
        plan = _final_plan(df)
        assert "partial_" in plan
    hot = latest.latest_by_city(ev).where("city_id = 'c7'").collect()[0]
    assert hot.temperature_2m == float(119_997 % 97)
