"""Live gauges and rates.

I3 keeps the latest value per city as streaming state; the state holds one
row per city, so it grows with the number of cities, not with time.

I5 counts events per city in event-time windows.  The reference has no
watermark; one is added here (``watermark``) so window state is dropped once
a window can no longer change.  In ``append`` mode a window is emitted only
after the watermark passes its end; ``update``/``complete`` emit as counts
change.  Spark drops rows behind the watermark, which the reference never does:
:func:`start_whole_rate` keeps them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratus.operators.latest import latest_by_city
from stratus.operators.metrics import event_rate, window_counts, window_seconds
from stratus.sources.fs import Store


def live_latest(stream: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Streaming latest-per-city (use ``update`` or ``complete`` mode)."""
    return latest_by_city(stream, order_by=order_by)


def live_rate(
    events: DataFrame,
    ts: str = "ts",
    by: Sequence[str] = ("city_name",),
    width: str = "1 minute",
    slide: str | None = None,
    watermark: str | None = "2 minutes",
) -> DataFrame:
    """Event rate per window; ``ts`` must be TIMESTAMP (not NTZ)."""
    df = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        df = df.withWatermark(ts, watermark)
    return event_rate(df, ts=ts, by=by, width=width, slide=slide)


def live_last_fetch(stream: DataFrame, watermark: str = "2 days",
                    order_by: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """G3 on a stream: last fetch per (city_id, hour_ts).  The watermark on
    ``hour_ts`` (a grouping key) bounds the state: an hour is final, emitted
    in append mode and dropped from state, once the watermark passes it."""
    keys = ("city_id", "hour_ts")
    rest = [c for c in stream.columns if c not in keys]
    return (
        stream.withWatermark("hour_ts", watermark)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_r"))
        .select(*keys, "_r.*")
    )


def start_snapshot(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   output_mode: str = "complete") -> StreamingQuery:
    """Keep a Parquet snapshot of an aggregating stream.

    ``complete``: each batch rewrites the snapshot with the whole result.
    ``update``: each batch writes its changed rows to ``batch=<id>``; the
    newest row per key wins when read (see ``read_updates``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(path)
        else:
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{path}/batch={batch_id}"
            )

    w = df.writeStream.outputMode(output_mode).foreachBatch(write).option(
        "checkpointLocation", checkpoint
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_updates(spark, path: str, keys: Sequence[str]) -> DataFrame:
    """Read an ``update``-mode snapshot: the newest row per key across the
    ``batch=<id>`` folders (a ``max_by`` aggregate, no single-task step)."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "batch_id", "batch")]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_r"))
        .select(*keys, "_r.*")
    )


# --- rates without loss ------------------------------------------------------
def start_whole_rate(events: DataFrame, path: str, checkpoint: str, ts: str = "ts", by: Sequence[str] = ("city_name",),
                     width: str = "1 minute", slide: str | None = None, delay: str = "2 minutes",
                     trigger: dict | None = None) -> StreamingQuery:
    """I5 where nothing is lost: an ``append`` stream of counts per (window, label).

    Every micro-batch adds its own counts under ``counts/batch=<id>/``.  The
    watermark (largest event time of all earlier batches, less ``delay``) tells what
    is late: counts for windows that were closed by then are so marked, and the late
    rows themselves go to ``late/batch=<id>/`` as well.  :func:`read_rates` adds a
    closed window's late counts to it.  There is no window state to evict; folders
    are keyed by batch, so a replay counts nothing twice; :func:`compact_rates`
    folds old batches into one folder.
    """
    seconds = window_seconds(delay)

    def each(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession)
        mark = _mark_before(store, path, batch_id)
        batch = batch.withColumn(ts, F.col(ts).cast("timestamp")).persist()
        try:
            closed = F.lit(None).cast("timestamp") if mark is None else F.timestamp_micros(F.lit(mark - seconds * 10 ** 6))
            counts = window_counts(batch, ts, by, width, slide)
            late_n = F.when(F.col("window_end") <= closed, F.col("n")).otherwise(F.lit(0))
            counts.withColumn("late_n", late_n.cast("long")).write.mode("overwrite").parquet(
                f"{path}/counts/batch={batch_id}")
            behind = batch.where(F.col(ts) < closed)
            behind.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            newest = batch.agg(F.max(F.unix_micros(ts))).first()[0]
            newest = max((x for x in (newest, mark) if x is not None), default=None)
            name = f"{path}/marks/batch={batch_id}.json"
            store.delete(name)
            store.write_new(name, json.dumps({"newest": newest, "delay": seconds}))
        finally:
            batch.unpersist()

    w = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def _numbered(store: Store, folder: str, form: str) -> list[int]:
    return sorted(int(m[1]) for m in (re.fullmatch(form, n) for n in store.names(folder)) if m)


def _mark_before(store: Store, path: str, batch_id: int | None = None) -> int | None:
    """Largest event time (microseconds) of the batches before ``batch_id``."""
    ids = [k for k in _numbered(store, f"{path}/marks", r"batch=(\d+)\.json") if batch_id is None or k < batch_id]
    return json.loads(store.read_text(f"{path}/marks/batch={ids[-1]}.json"))["newest"] if ids else None


def _count_folders(store: Store, path: str) -> list[str]:
    """The folders that make up all counts: the newest fold, and the batches after it."""
    folds = _numbered(store, f"{path}/counts", r"to=(\d+)")
    folds = [k for k in folds if store.exists(f"{path}/counts/to={k}/_SUCCESS")]
    upto = max(folds, default=-1)
    batches = [k for k in _numbered(store, f"{path}/counts", r"batch=(\d+)") if k > upto]
    done = [f"{path}/counts/batch={k}" for k in batches if store.exists(f"{path}/counts/batch={k}/_SUCCESS")]
    return ([f"{path}/counts/to={upto}"] if upto >= 0 else []) + done


def _all_counts(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        raise FileNotFoundError(f"{path}: no finished batch yet")
    rows = spark.read.parquet(*folders)
    keys = [c for c in rows.columns if c not in ("n", "late_n")]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("late_n").alias("late_n"))


def read_rates(spark: SparkSession, path: str, width: str = "1 minute", closed_only: bool = False) -> DataFrame:
    """(window_start, labels, rate, late_n): all counts so far, late ones included;
    ``closed_only`` leaves out windows that the watermark has not passed."""
    store = Store(spark)
    counts = _all_counts(spark, path, _count_folders(store, path))
    if closed_only:
        marks = _numbered(store, f"{path}/marks", r"batch=(\d+)\.json")
        mark = json.loads(store.read_text(f"{path}/marks/batch={marks[-1]}.json"))
        closed = None if mark["newest"] is None else mark["newest"] - mark["delay"] * 10 ** 6
        counts = counts.where(F.col("window_end") <= F.timestamp_micros(F.lit(closed).cast("long")))
    labels = [c for c in counts.columns if c not in ("window_start", "window_end", "n", "late_n")]
    rate = F.col("n") / F.lit(float(window_seconds(width)))
    return counts.select("window_start", *labels, rate.alias("rate"), "late_n")


def compact_rates(spark: SparkSession, path: str) -> None:
    """Fold all finished batches' counts but the newest (which may be replayed) into
    one folder, then drop what it replaces."""
    store = Store(spark)
    folders = _count_folders(store, path)
    batches = [f for f in folders if "/batch=" in f][:-1]
    if not batches:
        return
    folded = [f for f in folders if "/to=" in f] + batches
    upto = batches[-1].rpartition("=")[2]
    _all_counts(spark, path, folded).write.mode("overwrite").parquet(f"{path}/counts/to={upto}")
    for f in folded:
        store.delete(f)
