"""Counters, rates, histograms and labelled series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.text import label_match
from stratus.operators.latest import packed_order
from stratus.schemas import LATENCY_BUCKETS, SERIES_PREFIXES


def city_event_counts(current: DataFrame) -> DataFrame:
    """E5: events per city (a missing or empty country is labelled ``na``)."""
    return current.groupBy(
        "city_id", "city_name",
        F.coalesce(F.nullif(F.col("country"), F.lit("")), F.lit("na")).alias("country")
    ).agg(F.count(F.lit(1)).alias("events"))


def event_rate(
    events: DataFrame,
    ts: str = "ts",
    by: Sequence[str] = ("city_name",),
    width: str = "1 minute",
    slide: str | None = None,
    select: dict[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Events per second over event-time windows, by label.

    ``count / window seconds``, exact (no extrapolation).  ``slide`` gives
    overlapping windows (each event falls in width/slide windows).  ``select``
    is a label filter ``{label: [values]}`` matched as an anchored regex
    alternation (C9); None or [] means All.
    """
    df = events
    for label, values in (select or {}).items():
        df = df.where(label_match(label, values))
    counts = window_counts(df, ts, by, width, slide)
    return counts.select("window_start", *by, (F.col("n") / F.lit(float(window_seconds(width)))).alias("rate"))


def window_counts(events: DataFrame, ts: str = "ts", by: Sequence[str] = ("city_name",), width: str = "1 minute",
                  slide: str | None = None) -> DataFrame:
    """(window_start, window_end, labels, n): events per window and label."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (events.groupBy(w.alias("window"), *by).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n"))


def window_seconds(interval: str) -> int:
    """Seconds of ``"<n> <unit>"``."""
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def sum_latest(
    samples: DataFrame,
    series: Sequence[str],
    by: Sequence[str],
    order_by: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """Latest sample of each series, then summed by labels
    (``sum(gauge) by (labels)``)."""
    last = samples.groupBy(*series).agg(
        F.max_by("value", packed_order(samples, order_by)).alias("value")
    )
    return last.groupBy(*by).agg(F.sum("value").alias("value"))


def _bucket_name(b: float) -> str:
    return "le_inf" if b == float("inf") else "le_" + f"{b:g}".replace(".", "_")


def latency_histogram(
    log: DataFrame, by: Sequence[str] = ("kind",), buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Calls, failures, latency sum and cumulative bucket counts per kind
    (one pass; each bucket is a ``count_if(sec <= bound)``).

    A call counts once a reply came (``replied``; a log without that column has
    replies only), its latency only if it did not fail; a failure counts always."""
    sec = F.when(F.col("reason").isNull(), F.col("sec"))
    replied = F.col("replied") if "replied" in log.columns else F.lit(True)
    cols = [
        F.count_if(replied).alias("calls"),
        F.count("reason").alias("failures"),
        F.sum(sec).alias("sum_sec"),
    ]
    for b in buckets:
        cond = sec.isNotNull() if b == float("inf") else sec <= F.lit(b)
        cols.append(F.count_if(cond).alias(_bucket_name(b)))
    return log.groupBy(*by).agg(*cols)


def failures_by_reason(log: DataFrame, by: Sequence[str] = ("kind", "reason")) -> DataFrame:
    """Failures counted by kind and reason."""
    return log.where(F.col("reason").isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("failures")
    )


def producer_failures(log: DataFrame) -> DataFrame:
    """Failed sends by topic and reason (log of ``topic, reason``; a null
    reason is a message that was sent)."""
    return failures_by_reason(log, by=("topic", "reason"))


def messages_per_poll(polls: DataFrame) -> DataFrame:
    """Messages sent per poll: 2 for a city with a current value (raw +
    current), 1 without.  Input: one row per (poll, city) with
    ``has_current``."""
    return polls.groupBy("poll").agg(
        F.sum(F.when(F.col("has_current"), 2).otherwise(1)).alias("messages"),
        F.count(F.lit(1)).alias("cities"),
    )


def chart_series(result: DataFrame, prefixes: Sequence[str] = SERIES_PREFIXES) -> DataFrame:
    """Aggregate columns (``avg_``/``min_``/``max_``) of a result as one
    series each: (city_id, date, series, value).  Needs a ``date`` column."""
    if "date" not in result.columns:
        return result.sparkSession.createDataFrame(
            [], "city_id string, date date, series string, value double"
        )
    cols = [c for c in result.columns if c.startswith(tuple(prefixes))]
    return result.unpivot(["city_id", "date"], cols, "series", "value")


def default_choice(registry: DataFrame, label: str = "id", order_col: str | None = None,
                   n: int = 1) -> DataFrame:
    """The first ``n`` cities of the registry (the selector's default), in
    the registry's own order (``order_col``, its position in the document), or
    sorted by id where the table keeps no position."""
    rows = registry.where(F.col(label).isNotNull())
    return rows.orderBy(order_col or label).limit(n).select(label)


def choices(df: DataFrame, label: str) -> DataFrame:
    """Distinct values of a label (a selector's choice list)."""
    return df.select(label).where(F.col(label).isNotNull()).distinct()
