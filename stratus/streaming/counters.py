"""Running counters and sums that survive restarts.

Counters: an aggregating stream keeps its counts in checkpointed state, so they go
on where the last run stopped and never fall; each micro-batch replaces the changed
rows of the table that readers see.

Sums of gauges (``sum(gauge) by (labels)``): each micro-batch is reduced to its newest
sample per series and joined to the newest of all earlier ones, a table that is written
anew like the sums.  Every series that moved says which value it had (to retract) and
which it has now, and these differences are added to the sums by label.  Work per batch
is in proportion to its samples and to the number of series, all of it joins and
aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratus.operators import metrics
from stratus.streaming.versions import Versions


def _start(stream: DataFrame, each, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = stream.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def _same(keys: Sequence[str], left: str, right: str):
    """Equality of key columns where nulls are equal."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return same


def start_counters(counts: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Keep the rows of an aggregating stream (one per ``keys``) as a table; read it
    with :func:`stratus.streaming.versions.read_newest`."""
    def each(changed: DataFrame, batch_id: int) -> None:
        table = Versions(changed.sparkSession, path)
        changed = changed.persist()
        try:
            old = table.read(before=batch_id)
            if old is not None:
                stays = old.alias("o").join(changed.select(*keys).alias("n"), _same(keys, "o", "n"), "left_anti")
                table.write(stays.unionByName(changed), batch_id)
            else:
                table.write(changed, batch_id)
        finally:
            changed.unpersist()

    return _start(counts, each, checkpoint, trigger)


def start_city_events(current: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """E5: events per city since the first run."""
    return start_counters(metrics.city_event_counts(current), ("city_id", "city_name", "country"), path, checkpoint,
                          trigger)


def start_latency(log: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Calls, failures, latency sum and buckets per kind since the first run."""
    return start_counters(metrics.latency_histogram(log), ("kind",), path, checkpoint, trigger)


def start_failures(log: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("kind", "reason"),
                   trigger: dict | None = None) -> StreamingQuery:
    """Failures by kind (or topic) and reason since the first run."""
    return start_counters(metrics.failures_by_reason(log, by), by, path, checkpoint, trigger)


# --- sums of latest values ------------------------------------------------------
_NEWEST = ("_ts", "_seq", "_value")


def newest(samples: DataFrame, series: Sequence[str], ts: str = "ts", seq: str = "seq",
           value: str = "value") -> DataFrame:
    """(series..., _ts, _seq, _value): the newest sample per series, by ``ts``, then
    ``seq`` (null counts as the oldest); of equals the largest value."""
    nothing = -(2 ** 63)
    rows = samples.select(
        *series, F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(nothing)).alias("_ts"),
        F.coalesce(F.col(seq).cast("long"), F.lit(nothing)).alias("_seq"), F.col(value).cast("double").alias("_value"))
    return rows.groupBy(*series).agg(F.max(F.struct(*_NEWEST)).alias("_n")).select(*series, "_n.*")


def moves(samples: DataFrame, series: Sequence[str], by: Sequence[str], held: DataFrame | None = None,
          ts: str = "ts", seq: str = "seq", value: str = "value") -> DataFrame:
    """(series..., _ts, _seq, _value, old, new, added) per series whose newest sample is
    among ``samples`` and not among ``held`` (:func:`newest` of earlier ones).

    A sample that is not newer than the held one changes nothing; a null value counts
    as no number, as in a batch sum.  ``by`` are some of ``series``."""
    if not set(by) <= set(series):
        raise ValueError("labels must be part of what tells series apart")
    found = newest(samples, series, ts, seq, value)
    if held is None:
        return found.withColumns({"old": F.lit(None).cast("double"), "new": F.col("_value"), "added": F.lit(1)})
    both = found.alias("n").join(held.alias("o"), _same(series, "n", "o"), "left")
    place = [F.struct(f"{t}._ts", f"{t}._seq") for t in "no"]
    return both.where(F.col("o._ts").isNull() | (place[0] > place[1])).select(
        *[f"n.{c}" for c in (*series, *_NEWEST)], F.col("o._value").alias("old"), F.col("n._value").alias("new"),
        F.col("o._ts").isNull().cast("int").alias("added"))


def start_sum_latest(samples: DataFrame, series: Sequence[str], by: Sequence[str], path: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """E13 on a stream: (labels, value, series): the sum of the newest samples by label
    and how many series it has.

    The sums are the table under ``path``, the newest samples the one under
    ``path``/series; a replayed batch rebuilds both from their predecessors."""
    def each(batch: DataFrame, batch_id: int) -> None:
        table, state = (Versions(batch.sparkSession, p) for p in (path, f"{path.rstrip('/')}/series"))
        old, held = table.read(before=batch_id), state.read(before=batch_id)
        if (old is None) != (held is None):
            raise ValueError(f"{path}: sums and their series are not of one stream")
        moved = moves(batch, series, by, held).persist()
        try:
            now = moved.select(*series, *_NEWEST)
            if held is not None:
                now = held.alias("o").join(moved.alias("n"), _same(series, "o", "n"), "left_anti").unionByName(now)
            state.write(now, batch_id)
            change = moved.groupBy(*by).agg(
                (F.coalesce(F.sum("new"), F.lit(0.0)) - F.coalesce(F.sum("old"), F.lit(0.0))).alias("value"),
                F.sum("added").cast("long").alias("series"))
            both = change if old is None else old.unionByName(change)
            table.write(both.groupBy(*by).agg(F.sum("value").alias("value"), F.sum("series").alias("series")), batch_id)
        finally:
            moved.unpersist()

    moves(samples, series, by)  # wrong labels fail here, not in the first batch
    w = samples.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
