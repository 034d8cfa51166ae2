"""Input views derived from the shared test tables (see FIXTURES.md §2).

Each view is a lazy DataFrame over the Parquet tables, so every query built
on it scans the whole tables and grows with them.  The DuckDB twins of these
views live in :mod:`stratus.plans.oracle`.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.cities import created_id
from stratus.sources.files import read_table
from stratus.sources.streams import TOPIC_CURRENT, TOPIC_RAW


def _cities_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation (25 rows) and region (5 rows) have fixed sizes by the TPC-H
    # spec, so broadcasting them is safe at any scale factor.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    return (
        customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("city_key"),
            F.concat(F.lit("c"), k.cast("string")).alias("id"),
            F.col("c_name").alias("name"),
            F.upper(F.substring("r_name", 1, 2)).alias("country"),
            (((k * 37) % 1900).cast("double") / 10 - 95).alias("lat"),
            (((k * 53) % 3600).cast("double") / 10 - 180).alias("lon"),
            ((k % 5) != 0).alias("active"),
        )
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows: id, name, country, lat, lon, active."""
    return _cities_keyed(spark, sf_dir).drop("city_key")


def hourly(spark: SparkSession, sf_dir: str, with_seq: bool = True) -> DataFrame:
    """Hourly observations (bronze schema, plus ``fetch_seq`` arrival order).

    Joined on the numeric key (``user_id = c_custkey``), which is the same
    match as ``id = 'c' || user_id`` without building strings first.  The
    registry side is broadcast only when the planner measures it under the
    threshold; otherwise both sides are hash-partitioned (AQE splits a hot
    user's partition).
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    c = _cities_keyed(spark, sf_dir).select("city_key", "id", "name", "country")
    j = ev.join(c, ev["user_id"] == c["city_key"])
    cols = [
        F.col("id").alias("city_id"),
        F.col("name").alias("city_name"),
        "country",
        F.date_trunc("hour", "ts").cast("timestamp").alias("hour_ts"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .otherwise(F.col("value")).alias("temperature_2m"),
        F.get_json_object("props", "$.k").try_cast("double").alias("relative_humidity_2m"),
        (F.col("value") / 10).alias("wind_speed_10m"),
        F.to_date("ts").alias("date"),
    ]
    if with_seq:
        cols.append(F.col("event_id").alias("fetch_seq"))
    return j.select(*cols)


def day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as the API sends them: a day of 24 hours in parallel arrays,
    null elements among them, and current values.  Every third event has all three
    current values, every third only the temperature, the others none; error
    events hold no value at all, and some events have no city id.
    Columns: event_id, value (JSON)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    c = _cities_keyed(spark, sf_dir).select("city_key", "id", "name", "country")
    # An event becomes a hundred times its size in JSON: the rows are spread over all
    # cores first, however few files or partitions they come from.
    j = _spread(ev.join(c, ev["user_id"] == c["city_key"]), "event_id", "ts")
    day = F.date_format(F.col("ts"), "yyyy-MM-dd")
    error = F.col("event_type") == "error"

    def values(at):
        return F.array(*[F.when(~error, at(h)).cast("double") for h in range(24)])

    hourly_arrays = F.struct(
        F.array(*[F.concat(F.coalesce(day, F.lit("null")), F.lit(f"T{h:02d}:00")) for h in range(24)]).alias("time"),
        values(lambda h: F.col("value") + h if h % 5 else F.lit(None)).alias("temperature_2m"),
        values(lambda h: F.col("event_id") % 100 + h).alias("relative_humidity_2m"),
        values(lambda h: F.col("value") / 10 if h != 23 else F.lit(None)).alias("wind_speed_10m"),
    )
    k = F.col("event_id") % 3
    now = F.when(~error & (k < 2), F.struct(
        F.concat(day, F.lit("T12:00")).alias("time"), (F.col("value") * 2).alias("temperature_2m"),
        F.when(k == 0, F.lit(55.5)).alias("relative_humidity_2m"), F.when(k == 0, F.lit(1.25)).alias("wind_speed_10m")))
    meta = F.struct(
        F.when(F.col("event_id") % 97 == 0, F.lit("")).otherwise(F.col("id")).alias("city_id"),
        F.col("name").alias("city_name"), "country",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingested_at"))
    # A projection of its own: the arrays are made once, though the event holds them twice.
    parts = j.select("event_id", meta.alias("_meta"), now.alias("current"), hourly_arrays.alias("hourly"))
    raw = F.struct("hourly", "current")
    return parts.select("event_id", F.to_json(F.struct(
        "_meta", F.lit("open-meteo").alias("source"), "current", "hourly", raw.alias("raw"))).alias("value"))


#: Tasks per core of a step that does much work per row.
_TASKS = 4


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in a fixed number of partitions, which AQE does not merge by their few bytes."""
    return df.repartition(_TASKS * df.sparkSession.sparkContext.defaultParallelism, *keys)


def city_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their city labels and a session-zone ``ts``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    c = _cities_keyed(spark, sf_dir).select("city_key", "id", "name", "country")
    return ev.join(c, ev["user_id"] == c["city_key"]).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
        F.col("id").alias("city_id"), F.col("name").alias("city_name"), "country",
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows with exactly the bronze columns."""
    return hourly(spark, sf_dir, with_seq=False)


def events_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a session-zone timestamp (watermarks refuse TIMESTAMP_NTZ)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request status log: request_id, status, ts (text), log_offset."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return o.select(
        F.concat(F.lit("r"), (F.col("o_custkey") % 200).cast("string")).alias("request_id"),
        F.when(F.col("o_orderstatus") == "O", "submitted")
        .when(F.col("o_orderstatus") == "F", "success")
        .otherwise("error").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.col("o_orderkey").alias("log_offset"),
    )


def task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task instance states: run_id, task, state (NULL = unknown), pk."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_partkey"
    )
    return li.select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("task"),
        F.when(F.col("l_linestatus") == "F", "success")
        .when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise("failed").alias("state"),
        F.col("l_partkey").alias("pk"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled gauge samples (consumer lag): one series per (group, topic, part)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.lit("lag").alias("metric"),
        F.col("event_type").alias("consumergroup"),
        F.concat(F.lit("t"), (F.col("user_id") % 6).cast("string")).alias("topic"),
        F.col("user_id").alias("part"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        "value",
    )


def up_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape-target health samples: one series per target (user), value 1
    (up) or 0 (an error event)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.lit("up").alias("metric"),
        F.concat(F.lit("target-"), F.col("user_id").cast("string")).alias("target"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API call log: kind, failure reason (NULL = ok), latency seconds (of failed
    calls too), and whether a reply came (a third of the failures had none)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("E"), (F.col("user_id") % 3).cast("string"))).alias("reason"),
        (F.col("value") / 100).alias("sec"),
        ((F.col("event_type") != "error") | (F.col("user_id") % 3 != 2)).alias("replied"),
    )


def producer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message sends: topic and failure reason (NULL = sent)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, TOPIC_RAW).otherwise(TOPIC_CURRENT).alias("topic"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("P"), (F.col("event_id") % 4).cast("string"))).alias("reason"),
    )


def gappy_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with missing flags, empty names and countries, ids that need
    slugging, and every kind of invalid field."""
    k = F.col("city_key")
    return _cities_keyed(spark, sf_dir).select(
        k.alias("position"),
        F.when(k % 17 == 0, F.concat(F.lit("No_"), "id")).when(k % 19 == 0, F.lit("")).otherwise(F.col("id")).alias("id"),
        F.when(k % 9 == 0, F.lit("")).when(k % 10 == 0, F.lit(None)).otherwise(F.col("name")).alias("name"),
        F.when(k % 13 == 0, F.lit("")).when(k % 14 == 0, F.lit("EUR")).otherwise(F.col("country")).alias("country"),
        F.when(k % 15 == 0, F.lit(None)).otherwise(F.col("lat")).alias("lat"),
        (F.col("lon") * F.when(k % 16 == 0, 3).otherwise(1)).alias("lon"),
        F.when(k % 4 == 1, F.lit(None)).otherwise(F.col("active")).alias("active"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry change set: renamed/toggled existing cities + new ones.
    ``change_seq`` orders the changes (edits on even, additions on odd)."""
    c = _cities_keyed(spark, sf_dir)
    edits = c.where(F.length("id") % 2 == 0).select(
        "id", F.concat("name", F.lit(" v2")).alias("name"), "country", "lat", "lon",
        (~F.col("active")).alias("active"), (F.col("city_key") * 2).alias("change_seq"),
    )
    new = c.where(F.col("country") == "EU").select(
        F.concat(F.lit("n"), "id").alias("id"), "name", "country", "lat", "lon", "active",
        (F.col("city_key") * 2 + 1).alias("change_seq"),
    )
    return edits.unionByName(new)


def mixed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change operations in ``seq`` order, several per id: double toggles,
    updates and toggles after each other, deletes followed by updates (refused),
    cities created, deleted and created again, invalid and unknown ones."""
    k = _cities_keyed(spark, sf_dir)
    key = F.col("city_key")
    slug = created_id()

    def ops(when, op, at, id_=None, lat=None, country=None, name=None):
        return k.where(when).select(
            F.lit(op).alias("op"), (key * 10 + at).alias("seq"),
            (id_ if id_ is not None else F.col("id")).alias("id"),
            (name if name is not None else F.col("name")).alias("name"),
            (F.lit(country) if country else F.col("country")).alias("country"),
            (F.lit(lat) if lat is not None else F.col("lat")).alias("lat"), "lon", "active")

    parts = [
        ops(key % 3 == 0, "toggle", 1), ops(key % 6 == 0, "TOGGLE", 2),
        ops(key % 4 == 1, "update", 3, name=F.concat("name", F.lit(" u"))), ops(key % 4 == 1, "toggle", 4),
        ops(key % 5 == 2, "delete", 5), ops(key % 10 == 2, "update", 6),
        ops(key % 7 == 3, "create", 1, lat=1.0), ops(key % 7 == 3, "delete", 2, id_=slug),
        ops(key % 14 == 3, "create", 7, lat=2.0), ops(key % 14 == 3, "toggle", 8, id_=slug),
        ops(key % 11 == 0, "create", 9, country="XYZ"),
        ops(key % 50 == 0, "toggle", 9, id_=F.concat(F.lit("ghost"), key.cast("string"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Three requests covering avg/min/max, an empty city list, open dates and an
# unknown metric (FIXTURES.md §2).
REQUEST_ROWS = [
    ("r1", ["c1", "c2"], "2024-01-02", "2024-01-10", ["temperature_2m", "bogus"], "avg"),
    ("r2", [], None, None, ["wind_speed_10m", "temperature_2m"], "max"),
    ("r3", ["c5"], None, "2024-01-09", ["relative_humidity_2m"], "min"),
]


def requests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        REQUEST_ROWS,
        "request_id string, city_ids array<string>, date_from string, date_to string, "
        "metrics array<string>, agg string",
    )


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parametric request per order (many requests for the batched path):
    the customer's city, an 8-day window starting on day (orderkey mod 20)
    of January 2024, metrics by order status, aggregation by priority."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 20).cast("int"))
    metrics = (
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("temperature_2m")))
        .when(F.col("o_orderstatus") == "O",
              F.array(F.lit("wind_speed_10m"), F.lit("temperature_2m")))
        .otherwise(F.array(F.lit("relative_humidity_2m")))
    )
    agg = (F.when(F.col("o_orderpriority") == "1-URGENT", "max")
           .when(F.col("o_orderpriority") == "2-HIGH", "min").otherwise("avg"))
    return o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("request_id"),
        F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("city_ids"),
        F.date_format(start, "yyyy-MM-dd").alias("date_from"),
        F.date_format(F.date_add(start, 7), "yyyy-MM-dd").alias("date_to"),
        metrics.alias("metrics"),
        agg.alias("agg"),
    )


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
