"""Keep the last fetch per (city, hour) (G3, P1; off by default).

Each poll re-sends the whole day, so the hourly table holds many rows per
(city, hour) and averages are weighted by fetch count.  This opt-in step
keeps one row per (city_id, hour_ts): the one fetched last.  Written as a
``max_by`` aggregate (partial per task) rather than a ranking window, so a
hot key is merged piecewise instead of sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.operators.latest import packed_order

KEYS = ("city_id", "hour_ts")


def last_fetch(hourly: DataFrame, order_by: Sequence[str] | None = None,
               keys: Sequence[str] = KEYS) -> DataFrame:
    """``order_by`` defaults to ``fetch_seq``, else ``ingested_at`` (kept by
    ``flatten(keep_ingested_at=True)``)."""
    if order_by is None:
        order_by = [c for c in ("fetch_seq", "ingested_at") if c in hourly.columns][:1]
        if not order_by:
            raise ValueError("last_fetch needs a fetch-order column (fetch_seq or ingested_at)")
    rest = [c for c in hourly.columns if c not in keys]
    return (
        hourly.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), packed_order(hourly, order_by)).alias("_r"))
        .select(*keys, "_r.*")
        .select(*hourly.columns)
    )
