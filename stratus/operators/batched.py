"""Many parametric requests in one Spark job (D4, H16-H18 in columns).

Every request groups by (city, date), and every filter is on those keys, so
each request's answer is a slice of one per-(city, date, metric) statistics
table.  The table is built once (one two-phase aggregate over the hourly
rows), then requests are joined to it on equality keys:

* requests that list cities: explode the ids and the week buckets the
  (data-bounded) day range overlaps, join on (city_id, metric, week), keep
  the days in range;
* requests for all cities: explode the day range, join on (date, metric).

Both joins are equi-joins, so the planner can hash-partition both sides; no
nested-loop or cross product is built, however many requests arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.arrays import keep_known
from stratus.functions.text import csv_to_list, strip_ws
from stratus.schemas import AGGS, DAY_PATTERN, DEFAULT_AGG, DEFAULT_METRICS, DEFAULT_REQUEST_ID, METRICS

KEYS = ["city_id", "city_name", "country", "date"]


def daily_stats(bronze: DataFrame) -> DataFrame:
    """Long per-(city, date, metric) avg/min/max table."""
    aggs = []
    for m in METRICS:
        aggs += [
            F.avg(m).alias(f"avg__{m}"), F.min(m).alias(f"min__{m}"), F.max(m).alias(f"max__{m}"),
        ]
    wide = bronze.select(*KEYS, *METRICS).groupBy(*KEYS).agg(*aggs)
    per_metric = F.array(*[
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"avg__{m}").alias("avg"),
            F.col(f"min__{m}").alias("min"),
            F.col(f"max__{m}").alias("max"),
        )
        for m in METRICS
    ])
    return wide.select(*KEYS, F.inline(per_metric))


def _csv_list(c: Column) -> Column:
    # Lists travel as comma-joined text between steps: join, split, strip.
    return csv_to_list(F.array_join(F.coalesce(c, F.array().cast("array<string>")), ","))


def normalize_requests(requests: DataFrame) -> DataFrame:
    """Request rows -> resolved parameters plus an ``error`` text (NULL if OK).

    The one rule set for requests, single ones too: null and empty fields take
    the defaults, unknown metrics and repeats vanish, days are ``YYYY-MM-DD``.
    Built in two projections: the text work (list parsing, whitelist, date
    parsing) once per row, then the cheap checks on its results, so no
    expensive expression is inlined several times.
    """
    metrics_in = F.when(
        F.col("metrics").isNull() | (F.size("metrics") == 0),
        F.array(*[F.lit(m) for m in DEFAULT_METRICS]),
    ).otherwise(F.col("metrics"))
    parsed = requests.select(
        F.coalesce(F.nullif(F.col("request_id"), F.lit("")), F.lit(DEFAULT_REQUEST_ID)).alias("request_id"),
        _csv_list(F.col("city_ids")).alias("city_ids"),
        keep_known(_csv_list(metrics_in)).alias("metrics"),
        F.lower(F.coalesce(F.nullif(F.col("agg"), F.lit("")), F.lit(DEFAULT_AGG))).alias("agg"),
        F.nullif(strip_ws(F.col("date_from")), F.lit("")).alias("_from_txt"),
        F.nullif(strip_ws(F.col("date_to")), F.lit("")).alias("_to_txt"),
    )
    dfrom, dto = (_day(F.col(c)) for c in ("_from_txt", "_to_txt"))
    error = (
        F.when(~F.col("agg").isin(*AGGS), F.concat(F.lit("invalid agg: "), F.col("agg")))
        .when(F.size("metrics") == 0, F.lit("no valid metric requested"))
        .when(F.col("_from_txt").isNotNull() & dfrom.isNull(),
              F.concat(F.lit("invalid date_from: "), F.col("_from_txt")))
        .when(F.col("_to_txt").isNotNull() & dto.isNull(),
              F.concat(F.lit("invalid date_to: "), F.col("_to_txt")))
    )
    return parsed.select(
        "request_id", "city_ids", dfrom.alias("date_from"), dto.alias("date_to"),
        "metrics", "agg", error.alias("error"),
    )


def batched_query(bronze: DataFrame, requests: DataFrame) -> DataFrame:
    """All valid requests answered in long form.

    Output: request_id, city_id, city_name, country, date, metric, metric_pos,
    agg, value.  Pivot one request with :func:`to_wide`.
    """
    return batched_from_stats(daily_stats(bronze), requests)


def batched_from_stats(stats: DataFrame, requests: DataFrame) -> DataFrame:
    """Same, over a stored :func:`daily_stats` table (the request stream reads
    that small gold table instead of rescanning the hourly rows)."""
    # No row filters on parsed columns: a filter would be pushed below the
    # projection and re-run the parsing.  Invalid requests explode no metric,
    # an empty or inverted day range explodes no day, and each branch below
    # explodes nothing for the requests it does not handle.
    req = normalize_requests(requests)
    per_metric = req.select(
        "request_id", "city_ids", "date_from", "date_to", "agg",
        F.posexplode(F.when(F.col("error").isNull(), F.col("metrics"))).alias("metric_pos", "metric"),
    )
    asked = _asked_days(requests)
    stats = stats.where(F.col("date").between(asked.getField("lo"), asked.getField("hi")))
    # Open bounds are closed with the data's first and last day (one scalar
    # subquery returning both, evaluated once), so every day range is finite.
    bounds = stats.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    start = F.greatest(F.coalesce(F.col("date_from"), lo), lo)
    stop = F.least(F.coalesce(F.col("date_to"), hi), hi)
    ranged = per_metric.select(
        "request_id", "agg", "metric_pos", "metric", "city_ids",
        start.alias("_start"), stop.alias("_stop"),
    )
    # Requests that list cities: a range condition on the day, answered as an
    # equi-join on week buckets (each request explodes the few weeks it
    # overlaps), then the exact day filter.  A request reads at most its
    # weeks of its cities' stats, not the cities' whole history.
    weeks = F.sequence(_week(F.col("_start")), _week(F.col("_stop")))
    listed = (
        ranged.select("request_id", "agg", "metric_pos", "metric", "_start", "_stop",
                      F.explode(F.array_distinct("city_ids")).alias("city_id"))
        .select("*", F.explode(F.when(F.col("_start") <= F.col("_stop"), weeks)).alias("_wk"))
        .join(stats.withColumn("_wk", _week(F.col("date"))), ["city_id", "metric", "_wk"])
        .where(F.col("date").between(F.col("_start"), F.col("_stop")))
    )
    # Requests for all cities: every asked (day, metric) joined to all cities.
    every_city = (
        ranged.where(F.size("city_ids") == 0)
        .select("request_id", "agg", "metric_pos", "metric",
                F.explode(F.when(F.col("_start") <= F.col("_stop"),
                                 F.sequence("_start", "_stop"))).alias("date"))
        .join(stats, ["date", "metric"])
    )
    cols = ["request_id", *KEYS, "metric", "metric_pos", "agg"]
    value = (
        F.when(F.col("agg") == "avg", F.col("avg"))
        .when(F.col("agg") == "min", F.col("min"))
        .otherwise(F.col("max"))
        .alias("value")
    )
    return (
        listed.select(*cols, value)
        .unionByName(every_city.select(*cols, value))
    )


def _asked_days(requests: DataFrame) -> Column:
    """First and last day that any request asks for, as one scalar subquery that
    prunes the stats' partitions when the query runs: no job runs while it is built.
    Only the days are parsed here; an invalid request may widen the range, which
    costs reading only."""
    dfrom, dto = (_day(F.nullif(strip_ws(F.col(c)), F.lit(""))) for c in ("date_from", "date_to"))
    return requests.select(dfrom.alias("f"), dto.alias("t")).agg(F.struct(
        F.min(F.coalesce("f", F.lit("0001-01-01").cast("date"))).alias("lo"),
        F.max(F.coalesce("t", F.lit("9999-12-31").cast("date"))).alias("hi"))).scalar()


def _day(c: Column) -> Column:
    """``YYYY-MM-DD`` text -> date; null for anything else."""
    return F.when(c.rlike(DAY_PATTERN), c.try_cast("date"))


def _week(d: Column) -> Column:
    """Week bucket of a day (days since the epoch div 7)."""
    return F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / 7)


def write_stats(stats: DataFrame, path: str) -> None:
    """Store :func:`daily_stats` as a gold table partitioned by ``date``
    (built by the daily job; read by the request stream)."""
    # Rebalanced, not repartitioned: AQE splits a large day over several tasks.
    (stats.hint("rebalance", "date").sortWithinPartitions("date", "city_id", "metric")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def request_errors(requests: DataFrame) -> DataFrame:
    """(request_id, error) for requests that cannot run."""
    return normalize_requests(requests).where(F.col("error").isNotNull()).select(
        "request_id", "error"
    )


def to_wide(long: DataFrame, request_id: str, metrics: list[str], agg: str) -> DataFrame:
    """One request's long rows -> its wide result (``<agg>_<metric>`` columns,
    request order)."""
    one = long.where(F.col("request_id") == request_id)
    wide = one.groupBy(*KEYS).pivot("metric", list(metrics)).agg(F.first("value"))
    return wide.select(*KEYS, *[F.col(m).alias(f"{agg}_{m}") for m in metrics]).orderBy(
        "city_id", "date"
    )
