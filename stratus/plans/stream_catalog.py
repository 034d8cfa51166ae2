"""Streaming twins of batch queries (I1 I3 I4 I5 I6; D1 D2 E5 E8 E10 E11 E13 as streams).

Each entry writes its input (derived from the tables by Spark) to a folder
under the shared checkpoint directory, runs the streaming query to the end
of that input (``availableNow``), and reads the sink back.  The SQL twin is
the batch query's: stream and batch must give the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators import batched, current, envelope, flatten
from stratus.plans import oracle as O
from stratus.plans import views as V
from stratus.plans.catalog import CURRENT_RANKED, SQL, _now_requests, register
from stratus.session import scratch_path
from stratus.sources.files import read_statuses
from stratus.sources.sinks import Sink, write_registry
from stratus.sources.streams import Source, parse_hourly_messages, read_stream
from stratus.streaming import counters, live, lookups, polls, requests as sr
from stratus.streaming import hourly as sh
from stratus.streaming.versions import read_newest

AVAILABLE_NOW = {"availableNow": True}


def _dirs(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def _envelope_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    env = envelope.envelope(envelope.replies_from_hourly(V.hourly(spark, sf_dir)))
    env.select("value").write.text(path)


def _await(qs) -> None:
    for q in qs:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


@register("stream_flatten", SQL["hourly_flatten"])
def q_stream_flatten(spark, sf_dir):
    """Raw files -> flatten stream -> bronze Parquet + hourly messages."""
    base = _dirs(spark, "flatten")
    _envelope_files(spark, sf_dir, f"{base}/raw")
    raw = read_stream(spark, Source("files", path=f"{base}/raw"))
    qs = sh.start_hourly(
        raw, Sink("parquet", path=f"{base}/bronze", partition_by=("date",)),
        Sink("json", path=f"{base}/hourly_messages"), f"{base}/ckpt", AVAILABLE_NOW,
    )
    _await(qs)
    b = spark.read.parquet(f"{base}/bronze")
    return b.select("city_id", "city_name", "country", "hour_ts", "temperature_2m",
                    "relative_humidity_2m", "wind_speed_10m", "date")


@register("stream_current", SQL["current_flat"])
def q_stream_current(spark, sf_dir):
    """I4: raw files -> current observations stream."""
    base = _dirs(spark, "current")
    _envelope_files(spark, sf_dir, f"{base}/raw")
    raw = read_stream(spark, Source("files", path=f"{base}/raw"))
    _await([sh.start_current(raw, Sink("parquet", path=f"{base}/out"), f"{base}/ckpt", AVAILABLE_NOW)])
    return spark.read.parquet(f"{base}/out")


@register("stream_latest", SQL["latest_by_city"])
def q_stream_latest(spark, sf_dir):
    """Stateful latest-per-city over a stream of hourly rows."""
    base = _dirs(spark, "latest")
    h = V.hourly(spark, sf_dir)
    h.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(h.schema).parquet(f"{base}/in")
    q = live.start_snapshot(live.live_latest(stream), f"{base}/out", f"{base}/ckpt",
                            AVAILABLE_NOW, "complete")
    _await([q])
    return spark.read.parquet(f"{base}/out")


@register("stream_dedup", SQL["hourly_dedup"])
def q_stream_dedup(spark, sf_dir):
    """G3 on a stream: last fetch per (city, hour).  ``update`` mode: the state
    holds the hours the watermark has not passed, the sink the newest row of each."""
    base = _dirs(spark, "dedup")
    h = V.hourly(spark, sf_dir)
    h.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(h.schema).parquet(f"{base}/in")
    q = live.start_snapshot(live.live_last_fetch(stream, watermark="2 days", order_by=("fetch_seq",)),
                            f"{base}/out", f"{base}/ckpt", AVAILABLE_NOW, "update")
    _await([q])
    return live.read_updates(spark, f"{base}/out", ["city_id", "hour_ts"]).select(*h.columns)


@register("stream_rate", SQL["event_rate_1m"])
def q_stream_rate(spark, sf_dir):
    """Per-minute rate by city with a watermark that drops closed windows from
    the state (``update`` mode)."""
    base = _dirs(spark, "rate")
    ev = V.city_events(spark, sf_dir)
    ev.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
    q = live.start_snapshot(live.live_rate(stream), f"{base}/out", f"{base}/ckpt",
                            AVAILABLE_NOW, "update")
    _await([q])
    return live.read_updates(spark, f"{base}/out", ["window_start", "city_name"])


@register("stream_requests", SQL["batched_requests"])
def q_stream_requests(spark, sf_dir):
    """Request stream answered per micro-batch; results by request id."""
    base = _dirs(spark, "requests")
    V.requests(spark).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/in")
    stats_path = f"{base}/stats"
    batched.daily_stats(V.bronze(spark, sf_dir)).write.parquet(stats_path)
    stats = spark.read.parquet(stats_path)
    raw = read_stream(spark, Source("files", path=f"{base}/in"))
    q = sr.start_requests(raw, stats, f"{base}/results", f"{base}/status", f"{base}/ckpt",
                          AVAILABLE_NOW)
    _await([q])
    res = spark.read.parquet(f"{base}/results")
    return res.select("request_id", "city_id", "city_name", "country", "date", "metric",
                      F.col("metric_pos").cast("int").alias("metric_pos"), "agg", "value")



@register("stream_messages", O.with_(O.HOURLY) + f"""
SELECT city_id, city_name, country, {O.TS('hour_ts')} AS hour_ts, {O.R('temperature_2m')} AS temperature_2m,
       {O.R('relative_humidity_2m')} AS relative_humidity_2m, {O.R('wind_speed_10m')} AS wind_speed_10m
FROM hourly""")
def q_stream_messages(spark, sf_dir):
    """The flatten stream's second sink, read back as messages."""
    base = _dirs(spark, "messages")
    _envelope_files(spark, sf_dir, f"{base}/raw")
    raw = read_stream(spark, Source("files", path=f"{base}/raw"))
    _await(sh.start_hourly(raw, Sink("parquet", path=f"{base}/bronze"),
                           Sink("json", path=f"{base}/messages"), f"{base}/ckpt", AVAILABLE_NOW))
    msgs = spark.read.schema("key string, value string").json(f"{base}/messages")
    return parse_hourly_messages(msgs.select("value"))


@register("stream_statuses", """
SELECT concat('o', CAST(o_orderkey AS VARCHAR)) AS request_id, status
FROM orders, (VALUES ('submitted'), ('success')) AS t(status)""")
def q_stream_statuses(spark, sf_dir):
    """Every status the request stream publishes for one request per order."""
    base = _dirs(spark, "statuses")
    V.order_requests(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/in")
    batched.write_stats(batched.daily_stats(V.bronze(spark, sf_dir)), f"{base}/stats")
    raw = read_stream(spark, Source("files", path=f"{base}/in"))
    _await([sr.start_requests(raw, f"{base}/stats", f"{base}/results", f"{base}/status", f"{base}/ckpt",
                              AVAILABLE_NOW)])
    return read_statuses(spark, f"{base}/status").select("request_id", "status")


# --- registry on the stream (D1 D2) ------------------------------------------
ASKED_DDL = "event_id bigint, city_id string"


def _registry(spark, sf_dir, base: str) -> str:
    write_registry(V.cities(spark, sf_dir), f"{base}/registry", 1, "tests")
    return f"{base}/registry"


@register("stream_now_lookup", SQL["now_lookup"])
def q_stream_now_lookup(spark, sf_dir):
    """Lookup requests as they arrive, against the registry of each micro-batch."""
    base = _dirs(spark, "now")
    _now_requests(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/in")
    stream = lookups.parse_lookups(read_stream(spark, Source("files", path=f"{base}/in")), ASKED_DDL)
    sink = Sink("parquet", path=f"{base}/out")
    _await([lookups.start_lookup(stream, _registry(spark, sf_dir, base), sink, f"{base}/ckpt", AVAILABLE_NOW)])
    ddl = f"{ASKED_DDL}, name string, country string, lat double, lon double"
    return lookups.read_step(spark, sink, "found", ddl)


@register("stream_now_unknown", SQL["now_unknown"])
def q_stream_now_unknown(spark, sf_dir):
    """Ids that the registry does not have, or has switched off."""
    base = _dirs(spark, "unknown")
    _now_requests(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/in")
    stream = lookups.parse_lookups(read_stream(spark, Source("files", path=f"{base}/in")), ASKED_DDL)
    sink = Sink("json", path=f"{base}/out")
    _await([lookups.start_lookup(stream, _registry(spark, sf_dir, base), sink, f"{base}/ckpt", AVAILABLE_NOW)])
    return lookups.read_step(spark, sink, "unknown", ASKED_DDL)


@register("stream_attach_city", SQL["hourly_flatten"])
def q_stream_attach_city(spark, sf_dir):
    """Replies without names get the registry's on the stream, become raw
    events, and flatten to the hourly rows."""
    base = _dirs(spark, "attach")
    replies = envelope.replies_from_hourly(V.hourly(spark, sf_dir)).drop("city_name", "country")
    replies.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(replies.schema).option("maxFilesPerTrigger", "4").parquet(f"{base}/in")
    sink = Sink("text", path=f"{base}/out")
    _await([lookups.start_envelopes(stream, _registry(spark, sf_dir, base), sink, f"{base}/ckpt", AVAILABLE_NOW)])
    return flatten.flatten(lookups.read_step(spark, sink, "events", "value string"))


# --- counters and sums over two runs of one checkpoint (E5 E8 E10 E11 E13) ------
def _two_runs(spark, rows, base: str, start) -> None:
    """Half of ``rows`` arrives, the stream runs and stops; then the other half.
    ``rows`` are computed once, for both halves."""
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
    rows.withColumn("_half", half).write.partitionBy("_half").parquet(f"{base}/rows")
    for k in (0, 1):
        arrived = spark.read.schema(T.StructType([*rows.schema, T.StructField("_half", T.IntegerType())])).parquet(f"{base}/rows").where(F.col("_half") == k)
        arrived.drop("_half").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "2").parquet(f"{base}/in")
        _await([start(stream)])


@register("stream_city_events", SQL["city_event_counts"])
def q_stream_city_events(spark, sf_dir):
    """E5: events per city, counted on over a restart."""
    base = _dirs(spark, "city-events")
    raw = envelope.envelope(envelope.replies_from_hourly(V.hourly(spark, sf_dir)))
    flat = current.current_flat(raw)
    country = F.when(F.col("country") == "AF", F.lit(None)).when(F.col("country") == "AS", "").otherwise(F.col("country"))
    _two_runs(spark, flat.withColumn("country", country), base,
              lambda s: counters.start_city_events(s, f"{base}/out", f"{base}/ckpt", AVAILABLE_NOW))
    return read_newest(spark, f"{base}/out")


@register("stream_fetch_histogram", SQL["fetch_histogram"])
def q_stream_fetch_histogram(spark, sf_dir):
    """Calls, failures and latency buckets, counted on over a restart."""
    base = _dirs(spark, "histogram")
    _two_runs(spark, V.fetch_log(spark, sf_dir), base,
              lambda s: counters.start_latency(s, f"{base}/out", f"{base}/ckpt", AVAILABLE_NOW))
    return read_newest(spark, f"{base}/out")


@register("stream_producer_failures", SQL["producer_failures"])
def q_stream_producer_failures(spark, sf_dir):
    """Failed sends by topic and reason, counted on over a restart."""
    base = _dirs(spark, "failures")
    _two_runs(spark, V.producer_log(spark, sf_dir), base, lambda s: counters.start_failures(
        s, f"{base}/out", f"{base}/ckpt", ("topic", "reason"), AVAILABLE_NOW))
    return read_newest(spark, f"{base}/out")


@register("stream_sum_latest", SQL["sum_latest_by_labels"])
def q_stream_sum_latest(spark, sf_dir):
    """Newest sample per series, summed by label with retraction, over a restart."""
    base = _dirs(spark, "sums")
    _two_runs(spark, V.samples(spark, sf_dir), base, lambda s: counters.start_sum_latest(
        s, ["metric", "consumergroup", "topic", "part"], ["consumergroup", "topic"], f"{base}/out", f"{base}/ckpt",
        AVAILABLE_NOW))
    return read_newest(spark, f"{base}/out").select("consumergroup", "topic", "value")


@register("stream_poll_counters", CURRENT_RANKED + """
SELECT CAST(block % 20 AS BIGINT) AS poll, CAST(sum(CASE WHEN has_current THEN 2 ELSE 1 END) AS BIGINT) AS messages,
       count(*) AS cities
FROM cur GROUP BY 1""")
def q_stream_poll_counters(spark, sf_dir):
    """One micro-batch per poll; its counters as a listener observed them."""
    base = _dirs(spark, "polls")
    events = envelope.envelope(envelope.replies_from_hourly(V.hourly(spark, sf_dir)))
    events = events.select((F.col("block") % 20).cast("long").alias("poll"), "value")
    # One file per poll, all in one job: the events are built once.
    events.repartition("poll").write.partitionBy("poll").parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/in")
    sent = polls.observed(current.current_values(stream, keep=["poll"]))
    listener = polls.PollListener(spark, f"{base}/polls")
    spark.streams.addListener(listener)
    try:
        q = (sent.writeStream.format("parquet").option("path", f"{base}/sent")
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        polls.await_polls(q, spark, f"{base}/polls")
    finally:
        spark.streams.removeListener(listener)
    return polls.read_polls(spark, f"{base}/polls").select("poll", "messages", "cities")


@register("stream_rate_late", SQL["event_rate_sliding"])
def q_stream_rate_late(spark, sf_dir):
    """Sliding windows on an ``append`` stream whose later batches go back over
    the whole time: most of their rows are behind the watermark, none is lost.  Half
    way the counts are folded."""
    base = _dirs(spark, "rate-late")
    ev = V.city_events(spark, sf_dir)
    for k in range(4):
        ev.where(F.col("event_id") % 4 == k).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
        _await([live.start_whole_rate(stream, f"{base}/out", f"{base}/ckpt", slide="10 seconds", trigger=AVAILABLE_NOW)])
        if k == 2:
            live.compact_rates(spark, f"{base}/out")
    return live.read_rates(spark, f"{base}/out").drop("late_n")


# --- requests that fail while they run (I6) ---------------------------------------
@register("stream_failing_requests", """
SELECT concat(CASE WHEN s_suppkey % 500 = 7 THEN 'bad' ELSE 's' END, CAST(s_suppkey AS VARCHAR)) AS request_id,
       CASE WHEN s_suppkey % 500 = 7 THEN 'error' ELSE 'success' END AS status,
       CASE WHEN s_suppkey % 500 = 7 THEN 'cannot answer' END AS error
FROM supplier""")
def q_stream_failing_requests(spark, sf_dir):
    """One request per supplier; the answers of some fail while they run.  Those
    get ``error``, all others their answers."""
    base = _dirs(spark, "failing")
    s = V.read_table(spark, sf_dir, "supplier").select("s_suppkey")
    name = F.concat(F.when(F.col("s_suppkey") % 500 == 7, "bad").otherwise("s"), F.col("s_suppkey").cast("string"))
    asked = s.select(name.alias("request_id"), F.array(F.concat(F.lit("c"), F.col("s_suppkey").cast("string"))).alias("city_ids"))
    asked.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/in")
    batched.write_stats(batched.daily_stats(V.bronze(spark, sf_dir)), f"{base}/stats")

    def answer(stats, requests):
        fails = F.when(F.col("request_id").startswith("bad"), F.raise_error(F.lit("cannot answer")).cast("array<string>"))
        return batched.batched_from_stats(stats, requests.withColumn("city_ids", F.coalesce(fails, "city_ids")))

    raw = read_stream(spark, Source("files", path=f"{base}/in"), ordered=True)
    _await([sr.start_requests(raw, f"{base}/stats", f"{base}/results", f"{base}/status", f"{base}/ckpt", AVAILABLE_NOW,
                              answer=answer)])
    final = read_statuses(spark, f"{base}/status").where("status <> 'submitted'")
    return final.select("request_id", "status", F.regexp_extract("error", "cannot answer", 0).alias("error"))
