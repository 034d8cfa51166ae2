"""Daily aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.schemas import BRONZE_REQUIRED

GROUP_KEYS = ("city_id", "city_name", "country", "date")


class MissingColumns(RuntimeError):
    pass


def require_columns(df: DataFrame, required: Iterable[str] = BRONZE_REQUIRED) -> DataFrame:
    """A3: fail fast (no job runs) when the hourly table lacks a column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumns(f"missing columns in hourly table: {missing}")
    return df


def daily_aggregate(bronze: DataFrame) -> DataFrame:
    """Per (city, date) avg/min/max temperature, avg humidity, avg wind.

    Two-phase hash aggregate: partial sums per task before the shuffle, so a
    city holding a third of all rows costs one partial row per task, not a
    third of the data in one task.
    """
    require_columns(bronze)
    return bronze.groupBy(*GROUP_KEYS).agg(
        F.avg("temperature_2m").alias("avg_temperature_2m"),
        F.min("temperature_2m").alias("min_temperature_2m"),
        F.max("temperature_2m").alias("max_temperature_2m"),
        F.avg("relative_humidity_2m").alias("avg_relative_humidity_2m"),
        F.avg("wind_speed_10m").alias("avg_wind_speed_10m"),
    )


def write_daily(daily: DataFrame, path: str, mode: str = "full") -> None:
    """Write partitioned by ``date``.

    ``full`` rewrites every day (a run on part of the data erases the other
    days); ``dynamic`` replaces only the days present in ``daily``.  Rows are
    rebalanced by date: few files per day, and a large day is split over tasks.
    """
    if mode not in ("full", "dynamic"):
        raise ValueError(f"mode must be 'full' or 'dynamic', not {mode!r}")
    w = (
        daily.hint("rebalance", "date")
        .sortWithinPartitions("date", "city_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if mode == "full" else "dynamic")
        .partitionBy("date")
    )
    w.parquet(path)


def partition_presence(gold: DataFrame, day: str) -> DataFrame:
    """One row (date, n_rows, present) for one day of the gold table.

    The filter on the partition column prunes every other day's files.
    """
    d = F.lit(day).cast("date")
    n = gold.where(F.col("date") == d).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(d.alias("date"), "n_rows", (F.col("n_rows") > 0).alias("present"))
