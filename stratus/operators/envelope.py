"""Raw event envelope.

``replies_from_hourly`` regroups hourly rows into API-reply shaped records
(parallel arrays); ``envelope`` wraps a reply with the city metadata into the
raw event JSON.  Each reply holds at most ``block`` fetches: rows are grouped
by (city, fetch_seq div block) with a unique ``fetch_seq``, so no group can
grow with the data, whatever the skew of one city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.schemas import METRICS, RAW_HOUR_FORMAT, SOURCE_TAG

INGEST_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _field(name: str):
    return lambda x: x[name]


def replies_from_hourly(hourly: DataFrame, block: int = 24) -> DataFrame:
    """hourly rows (with ``fetch_seq``) -> one reply per (city, block).

    Output: city_id, city_name, country, block, ingested_at, hourly struct of
    arrays sorted by (hour_ts, fetch_seq).
    """
    keys = ["city_id", "city_name", "country"]
    item = F.struct(
        F.col("hour_ts"), F.col("fetch_seq"),
        *[F.col(m) for m in METRICS],
    )
    g = (
        hourly.withColumn("block", F.floor(F.col("fetch_seq") / F.lit(block)))
        .groupBy(*keys, "block")
        .agg(
            F.array_sort(F.collect_list(item)).alias("_items"),
            F.max("hour_ts").alias("_last_hour"),
            F.max("fetch_seq").alias("_last_seq"),
        )
    )
    arrays = F.struct(
        F.transform("_items", lambda x: F.date_format(x["hour_ts"], RAW_HOUR_FORMAT)).alias("time"),
        *[F.transform("_items", _field(m)).alias(m) for m in METRICS],
    )
    return g.select(
        *keys, "block", "_last_seq",
        F.date_format("_last_hour", INGEST_FORMAT).alias("ingested_at"),
        arrays.alias("hourly"),
    )


def attach_city(replies: DataFrame, cities: DataFrame) -> DataFrame:
    """Attach registry attributes to each reply by city id.

    Plain equi-join: the optimizer broadcasts the registry when its measured
    size is under the threshold, and shuffles both sides otherwise.
    """
    reg = cities.select(
        F.col("id").alias("city_id"), F.col("name").alias("city_name"), "country"
    )
    return replies.drop("city_name", "country").join(reg, "city_id")


def envelope(replies: DataFrame, with_current: bool = False) -> DataFrame:
    """Reply + metadata -> raw event JSON text in column ``value``.

    The arrays appear twice, at top level and under ``raw`` (the whole reply),
    as the producer sends them.  ``current`` is left out unless asked for.
    """
    meta = F.struct("city_id", "city_name", "country", "ingested_at").alias("_meta")
    raw_fields = [F.col("hourly").alias("hourly")]
    top = [meta, F.lit(SOURCE_TAG).alias("source")]
    if with_current:
        top.append(F.col("current").alias("current"))
        raw_fields.append(F.col("current").alias("current"))
    top += [F.col("hourly").alias("hourly"), F.struct(*raw_fields).alias("raw")]
    extra = [c for c in ("block", "_last_seq") if c in replies.columns]
    return replies.select(*extra, F.to_json(F.struct(*top)).alias("value"))
