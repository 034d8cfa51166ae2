"""Current observation with fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.arrays import last_element
from stratus.functions.plans import once
from stratus.functions.times import now_iso
from stratus.schemas import CURRENT_NAMES, METRICS, RAW_CURRENT_DDL, SOURCE_TAG

NAMES = [CURRENT_NAMES[m] for m in METRICS]


def current_values(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Raw event -> current values, one row per event (none dropped), with
    ``has_current`` telling whether any value was found.

    Per metric: the ``current`` value, else the last element of the top-level
    hourly array (read as text so one bad element does not null the array;
    an unparseable last element gives NULL), else NULL.  ``ts`` is the
    event's ingestion stamp (the moment the producer built it), or now when
    the event has none.
    """
    keep = list(keep or [])
    e = once(F.from_json(F.col(value_col), RAW_CURRENT_DDL))
    p = df.select(*keep, e.alias("_e"))
    vals = [
        F.coalesce(
            F.col(f"_e.current.{m}"),
            last_element(F.col(f"_e.hourly.{m}")).try_cast("double"),
        ).alias(CURRENT_NAMES[m])
        for m in METRICS
    ]
    out = p.select(
        *keep,
        F.col("_e._meta.city_id").alias("city_id"),
        F.col("_e._meta.city_name").alias("city_name"),
        F.col("_e._meta.country").alias("country"),
        F.coalesce(F.col("_e._meta.ingested_at"), now_iso()).alias("ts"),
        *vals,
        F.lit(SOURCE_TAG).alias("source"),
    )
    return out.withColumn("has_current", F.coalesce(*[F.col(n) for n in NAMES]).isNotNull())


def current_flat(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """B7 + C5: flat current observations; events with no value are dropped."""
    return current_values(df, value_col, keep).where("has_current").drop("has_current")
