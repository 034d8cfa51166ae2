"""Raw event -> hourly rows.

A raw event carries one column of values per metric (parallel arrays under
``raw.hourly``); the flatten zips them and emits one row per hour.  No shuffle:
parse, zip, generate and project all run inside one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratus.functions.plans import once
from stratus.functions.times import hour_key, json_ts, parse_hour
from stratus.schemas import KEY_SEPARATOR, METRICS, RAW_EVENT_DDL

_ARRAYS = {"time": "_t", **{m: f"_{i}" for i, m in enumerate(METRICS)}}


def parse_raw(df: DataFrame, value_col: str = "value") -> DataFrame:
    """B1: one ``from_json`` of the whole event (not one extract per field);
    unused fields are pruned by the declared schema."""
    return df.withColumn("_e", once(F.from_json(F.col(value_col), RAW_EVENT_DDL)))


def _zipped(df: DataFrame, value_col: str, keep: list[str]) -> DataFrame:
    p = parse_raw(df, value_col)
    h = F.col("_e.raw.hourly")
    return p.select(
        *keep,
        F.col("_e._meta.city_id").alias("city_id"),
        F.col("_e._meta.city_name").alias("city_name"),
        F.col("_e._meta.country").alias("country"),
        F.col("_e._meta.ingested_at").alias("ingested_at"),
        *[h[name].alias(alias) for name, alias in _ARRAYS.items()],
    ).withColumn("_z", F.arrays_zip(*_ARRAYS.values()))


def flatten(
    df: DataFrame,
    value_col: str = "value",
    keep_ingested_at: bool = False,
    keep: list[str] | None = None,
    observe: Observation | str | None = None,
) -> DataFrame:
    """B2: raw JSON text -> bronze rows.

    An event whose arrays are missing or do not parse yields no row (the zip
    is NULL); a short array is padded with NULLs; a bad hour text gives a
    NULL ``hour_ts`` (``try_to_timestamp``, ANSI stays on).
    ``keep`` passes extra input columns through (e.g. an arrival offset).
    ``observe`` (an ``Observation`` or, for streams, a name) attaches pipeline
    counters computed during the job itself: ``events``, ``dropped_events``
    and ``hourly_rows`` (in streaming they appear in the query progress under
    ``observedMetrics``).
    """
    keep = list(keep or [])
    z = _zipped(df, value_col, keep)
    if observe is not None:
        z = z.observe(
            observe,
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("_z").isNull()).alias("dropped_events"),
            F.coalesce(F.sum(F.size("_z")), F.lit(0)).alias("hourly_rows"),
        )
    rows = z.select(
        *keep, "city_id", "city_name", "country", "ingested_at", F.inline("_z")
    )
    cols: list[Column | str] = [
        *keep,
        "city_id", "city_name", "country",
        parse_hour(F.col(_ARRAYS["time"])).alias("hour_ts"),
        *[F.col(_ARRAYS[m]).cast("double").alias(m) for m in METRICS],
    ]
    if keep_ingested_at:
        cols.append("ingested_at")
    out = rows.select(*cols)
    return out.withColumn("date", F.to_date("hour_ts"))


def quarantined(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Events the flatten drops because an array is absent or bad."""
    z = _zipped(df, value_col, [value_col])
    return z.where(F.col("_z").isNull()).select(value_col, "city_id")


def hourly_payload(bronze: DataFrame) -> DataFrame:
    """(key, value) hourly message; key ``city_id|yyyyMMddHH``, value is
    JSON without ``date``, ``hour_ts`` as ISO text, null fields left out."""
    value = F.to_json(F.struct(
        "city_id", "city_name", "country",
        json_ts("hour_ts").alias("hour_ts"),
        *METRICS,
    ))
    key = F.concat_ws(KEY_SEPARATOR, F.col("city_id"), hour_key("hour_ts"))
    return bronze.select(key.alias("key"), value.alias("value"))
