"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.schemas import ISO_NOW_FORMAT, JSON_TS_FORMAT, KEY_HOUR_FORMAT


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_hour(c: Column | str) -> Column:
    """'2025-01-01T00:00' -> timestamp; NULL (not an error) on bad text."""
    return F.try_to_timestamp(_c(c))


def hour_key(c: Column | str) -> Column:
    return F.date_format(_c(c), KEY_HOUR_FORMAT)


def json_ts(c: Column | str) -> Column:
    return F.date_format(_c(c), JSON_TS_FORMAT)


def now_iso() -> Column:
    return F.date_format(F.current_timestamp(), ISO_NOW_FORMAT)


def epoch_or_iso(c: Column | str) -> Column:
    """Status ``ts`` is epoch seconds from one writer and ISO text from
    another; both become a timestamp."""
    c = _c(c)
    return F.coalesce(
        F.timestamp_seconds(c.try_cast("double")),
        F.try_to_timestamp(c),
    )
