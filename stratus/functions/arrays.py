"""Array helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.schemas import METRICS


def last_element(c: Column) -> Column:
    """Last element of an array; NULL for a NULL or empty array."""
    return F.try_element_at(c, F.lit(-1))


def keep_known(c: Column, allowed: Sequence[str] = METRICS) -> Column:
    """Metric whitelist: request order kept, repeats and unknown names dropped."""
    return F.array_intersect(c, F.array(*[F.lit(m) for m in allowed]))
