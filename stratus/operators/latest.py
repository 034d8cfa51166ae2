"""Latest value per key.

All of these are ``max_by`` aggregates: partial per task, then merged, so
one hot key never gathers its rows in one place, and the result does not
depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.times import epoch_or_iso
from stratus.schemas import (
    CURRENT_NAMES, METRICS, STATUS_ALIASES, TASK_SUCCESS, TASK_UNKNOWN,
)

CITY_KEYS = ("city_id", "city_name", "country")
# Orderings for "latest": event time of the hour then arrival, or arrival
# only (broker timestamp, partition, offset).
EVENT_TIME = ("hour_ts", "fetch_seq")
ARRIVAL = ("timestamp", "partition", "offset")


def event_order(df: DataFrame) -> tuple[str, ...]:
    """Default "latest" ordering for an hourly table: the hour, then the best
    fetch-order column present (``fetch_seq``, else ``ingested_at``); the hour
    alone on a plain bronze table."""
    for tie in ("fetch_seq", "ingested_at"):
        if tie in df.columns:
            return ("hour_ts", tie)
    return ("hour_ts",)


def packed_order(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The ordering columns as one fixed-width value, so that ``max_by`` runs as
    a hash aggregate (a struct order makes Spark sort every task's input).

    One column stays as it is.  A timestamp and an integer become
    ``micros * 2 * 10**19 + integer`` in decimal(38, 0): any long is less than
    10**19 from 0, so it never carries over, and the microseconds must fit 18
    digits (the cast fails beyond, in year 33658).  A null counts as the smallest.
    Any other combination stays a struct.
    """
    if len(order_by) == 1:
        return F.col(order_by[0])
    kinds = [df.schema[c].dataType for c in order_by]
    if (len(order_by) == 2 and isinstance(kinds[0], T.TimestampType)
            and isinstance(kinds[1], (T.LongType, T.IntegerType, T.ShortType))):
        micros = F.unix_micros(F.col(order_by[0])).cast("decimal(18,0)")
        step = F.lit(Decimal(2 * 10 ** 19)).cast("decimal(20,0)")
        return (F.coalesce(micros, F.lit(-(10 ** 18 - 1)).cast("decimal(18,0)")) * step
                + F.coalesce(F.col(order_by[1]).cast("long"), F.lit(-(2 ** 63))).cast("decimal(19,0)"))
    return F.struct(*[F.col(c) for c in order_by])


def last_non_null(value: Column | str, order: Column) -> Column:
    """Value at the largest ``order`` among rows where value is not NULL
    (a NULL never overwrites)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.max_by(v, F.when(v.isNotNull(), order))


def latest_by_city(
    hourly: DataFrame,
    order_by: Sequence[str] | None = None,
    keys: Sequence[str] = CITY_KEYS,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Latest non-null value of each metric per city, each on its own
    (C6: rows without a city id are ignored; C7: nulls are skipped).
    ``order_by`` defaults to :func:`event_order`; pass :data:`ARRIVAL` for
    broker order."""
    order_by = tuple(order_by or event_order(hourly))
    order = packed_order(hourly, order_by)
    valid = hourly.where(F.col("city_id").isNotNull() & (F.col("city_id") != ""))
    return valid.groupBy(*keys).agg(*[last_non_null(m, order).alias(m) for m in metrics])


def latest_current_by_city(current: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Latest temperature/humidity/wind per (city_id, city_name) from
    current observations (arrival order)."""
    return latest_by_city(
        current, order_by=order_by, keys=("city_id", "city_name"),
        metrics=[CURRENT_NAMES[m] for m in METRICS],
    )


def status_word(c: Column) -> Column:
    """One closed set of status words; ``done`` reads as ``success``."""
    w = F.lower(c)
    for alias, word in STATUS_ALIASES.items():
        w = F.when(w == alias, F.lit(word)).otherwise(w)
    return w


def latest_status(
    statuses: DataFrame,
    asked: DataFrame | None = None,
    order_by: Sequence[str] = ("ts_norm", "log_offset"),
) -> DataFrame:
    """Last message per request id, by ``order_by`` (a Kafka log's own order
    is ``timestamp, partition, offset``: :data:`ARRIVAL`).  ``ts`` may be epoch seconds or ISO
    text (normalised first); ties go to the later log position.  With ``asked``
    (a frame of request ids), ids without any message are ``pending``."""
    s = statuses
    if "ts_norm" in order_by and "ts_norm" not in s.columns:
        s = s.withColumn("ts_norm", epoch_or_iso("ts"))
    fields = [c for c in s.columns if c not in ("request_id", "ts_norm")]
    last = (
        s.groupBy("request_id")
        .agg(F.max_by(F.struct(*fields), F.struct(*order_by)).alias("_m"))
        .select("request_id", "_m.*")
        .withColumn("status", status_word(F.col("status")))
    )
    if asked is None:
        return last
    return (
        asked.select("request_id").distinct()
        .join(last, "request_id", "left")
        .withColumn("status", F.coalesce("status", F.lit("pending")))
    )


def status_rollup(task_states: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Overall outcome per run from its upstream task states.

    One state per (run, task) first (largest ``pk`` wins; a map cannot hold a
    key twice), a NULL state counts as ``unknown`` (hence failure); ``success``
    only if every task succeeded.  ``upstream`` is the sorted task -> state
    map.  With ``runs`` (run_id, run_state), runs without task rows fall back
    to the run state.

    The per-run collection happens after the (run, task) de-duplication, so
    it holds one entry per distinct task of the run (bounded by the DAG),
    not the run's raw rows, however many attempts a hot run logs.
    """
    state = F.coalesce(F.col("state"), F.lit(TASK_UNKNOWN))
    one = task_states.groupBy("run_id", "task").agg(
        F.max_by(F.col("state"), F.struct("pk", F.coalesce("state", F.lit("")))).alias("state")
    )
    per_run = one.groupBy("run_id").agg(
        F.every(state == F.lit(TASK_SUCCESS)).alias("ok"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("task"), state)))).alias(
            "upstream"
        ),
    )
    if runs is not None:
        per_run = runs.join(per_run, "run_id", "left").select(
            "run_id",
            F.coalesce("ok", F.lower("run_state") == TASK_SUCCESS).alias("ok"),
            F.coalesce(
                "upstream", F.create_map(F.lit("dag_run_state"), F.col("run_state"))
            ).alias("upstream"),
        )
    return per_run.select(
        "run_id",
        F.when(F.col("ok"), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        "upstream",
    )


def map_text(c: Column | str) -> Column:
    """Sorted ``k=v,k=v`` text of a string map (for display and compare)."""
    m = F.col(c) if isinstance(c, str) else c
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(m)),
                    lambda e: F.concat(e["key"], F.lit("="), e["value"])),
        ",",
    )
