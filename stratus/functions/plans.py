"""Help for the planner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """``c``, computed once per row.  Filters on what is read from a column are moved
    below its projection, also those that Spark infers from ``inline``, and compute it
    again, once per mention.  They stay above a column that is not deterministic, as
    this one is to Spark: ``floor(rand())`` is always 0 (which the optimizer doesn't see,
    other than ``rand() >= 0``)."""
    return F.when(F.floor(F.rand()) == 0, c)
