"""Query catalogue: one entry per operator family of the inventory.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``SQL[name]`` is the
same question for DuckDB over the same Parquet tables.  Every query reads the
whole tables (through :mod:`stratus.plans.views`), and both sides go through
the presentation rules of :mod:`stratus.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.functions.text import result_path
from stratus.jobs.status import status_of
from stratus.operators import (
    batched, cities, current, daily, dedup, envelope, flatten, latest, metrics, paramquery,
)
from stratus.plans import oracle as O
from stratus.plans import views as V
from stratus.schemas import GOLD_DDL
from stratus.session import scratch_path
from stratus.sources import registry
from stratus.sources.files import read_bronze, read_parquet_or_empty, read_registry_version, read_result, stored_day_presence
from stratus.sources.sinks import publish_requests, write_registry
from stratus.sources.streams import TOPIC_CURRENT, TOPIC_RAW, parse_statuses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: O.present(fn(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


BRONZE_COLS = (
    "city_id, city_name, country, {ts} AS hour_ts, {t} AS temperature_2m, "
    "{h} AS relative_humidity_2m, {w} AS wind_speed_10m, {d} AS date"
).format(
    ts=O.TS("hour_ts"), t=O.R("temperature_2m"), h=O.R("relative_humidity_2m"),
    w=O.R("wind_speed_10m"), d=O.D("date"),
)


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.envelope(envelope.replies_from_hourly(V.hourly(spark, sf_dir)))


# --- flatten (B1-B4, B6, H1-H9) -------------------------------------------
@register("hourly_flatten", O.with_(O.HOURLY) + f" SELECT {BRONZE_COLS} FROM hourly")
def q_hourly_flatten(spark, sf_dir):
    """hourly -> raw event envelopes -> flatten: gives the hourly rows back."""
    return flatten.flatten(_envelopes(spark, sf_dir))


@register("hourly_kafka_payload", O.with_(O.HOURLY) + f"""
SELECT concat(city_id, '|', strftime(hour_ts, '%Y%m%d%H')) AS key,
       count(*) AS n_messages,
       max(strftime(hour_ts, '%Y-%m-%dT%H:%M:%SZ')) AS hour_text,
       count(temperature_2m) AS n_with_temperature,
       {O.R('sum(temperature_2m)')} AS sum_temperature,
       {O.R('sum(wind_speed_10m)')} AS sum_wind
FROM hourly GROUP BY 1""")
def q_hourly_kafka_payload(spark, sf_dir):
    """Messages per key; null metrics are left out of the JSON, and the
    values read back from the JSON equal the source values."""
    p = flatten.hourly_payload(V.bronze(spark, sf_dir))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return p.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.max(field("hour_ts")).alias("hour_text"),
        F.count(field("temperature_2m")).alias("n_with_temperature"),
        F.sum(field("temperature_2m").try_cast("double")).alias("sum_temperature"),
        F.sum(field("wind_speed_10m").try_cast("double")).alias("sum_wind"),
    )


@register("current_flat", O.with_(O.HOURLY) + f"""
, ranked AS (
  SELECT *, floor(fetch_seq / 24) AS block,
         row_number() OVER (PARTITION BY city_id, city_name, country, floor(fetch_seq / 24)
                            ORDER BY hour_ts DESC, fetch_seq DESC) AS rn,
         max(hour_ts) OVER (PARTITION BY city_id, city_name, country, floor(fetch_seq / 24)) AS last_hour
  FROM hourly
)
SELECT city_id, city_name, country,
       strftime(last_hour, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts,
       {O.R('temperature_2m')} AS temperature_c,
       {O.R('relative_humidity_2m')} AS humidity_pct,
       {O.R('wind_speed_10m')} AS wind_ms,
       'open-meteo' AS source
FROM ranked
WHERE rn = 1
  AND coalesce(temperature_2m, relative_humidity_2m, wind_speed_10m) IS NOT NULL""")
def q_current_flat(spark, sf_dir):
    """Current values fall back to the last hourly element."""
    return current.current_flat(_envelopes(spark, sf_dir))


# --- daily aggregate (E1) -------------------------------------------------
@register("daily_weather", O.with_(O.HOURLY) + f"""
SELECT city_id, city_name, country, {O.D('date')} AS date,
       {O.R('avg(temperature_2m)')} AS avg_temperature_2m,
       {O.R('min(temperature_2m)')} AS min_temperature_2m,
       {O.R('max(temperature_2m)')} AS max_temperature_2m,
       {O.R('avg(relative_humidity_2m)')} AS avg_relative_humidity_2m,
       {O.R('avg(wind_speed_10m)')} AS avg_wind_speed_10m
FROM hourly GROUP BY city_id, city_name, country, date""")
def q_daily_weather(spark, sf_dir):
    return daily.daily_aggregate(V.bronze(spark, sf_dir))


# --- parametric queries (C1-C3 B5 E2 G1) ----------------------------------
PARAMS = {
    "param_avg": dict(request_id="q-avg", city_ids=["c1", " c2", "", "c3"],
                      date_from="2024-01-05", date_to="2024-01-20",
                      metrics=["temperature_2m", "relative_humidity_2m"], agg="avg"),
    "param_min": dict(request_id="q-min", city_ids=[], date_from="2024-01-10",
                      date_to="2024-01-12", metrics=["wind_speed_10m"], agg="MIN"),
    "param_max": dict(request_id="q-max", city_ids=["c7", "c11"], date_from=None,
                      date_to="2024-01-15",
                      metrics=["relative_humidity_2m", "bogus", "temperature_2m",
                               "wind_speed_10m"], agg="max"),
    "param_all_cities_open_range": dict(request_id="q-all"),
}


def _param_sql(cities: list[str], dfrom: str | None, dto: str | None,
               metrics: list[str], agg: str) -> str:
    where = ["TRUE"]
    if cities:
        where.append("city_id IN (" + ", ".join(f"'{c}'" for c in cities) + ")")
    if dfrom:
        where.append(f"date >= DATE '{dfrom}'")
    if dto:
        where.append(f"date <= DATE '{dto}'")
    cols = ", ".join(f"{O.R(f'{agg}({m})')} AS {agg}_{m}" for m in metrics)
    return (O.with_(O.HOURLY) + f" SELECT city_id, city_name, country, {O.D('date')} AS date, "
            f"{cols} FROM hourly WHERE {' AND '.join(where)} "
            "GROUP BY city_id, city_name, country, date")


PARAM_SQL = {
    "param_avg": _param_sql(["c1", "c2", "c3"], "2024-01-05", "2024-01-20",
                            ["temperature_2m", "relative_humidity_2m"], "avg"),
    "param_min": _param_sql([], "2024-01-10", "2024-01-12", ["wind_speed_10m"], "min"),
    "param_max": _param_sql(["c7", "c11"], None, "2024-01-15",
                            ["relative_humidity_2m", "temperature_2m", "wind_speed_10m"], "max"),
    "param_all_cities_open_range": _param_sql([], None, None, ["temperature_2m"], "avg"),
}


def _param_query(name: str) -> Query:
    def run(spark, sf_dir):
        p = paramquery.resolve(PARAMS[name])
        return paramquery.param_query(V.bronze(spark, sf_dir), p)
    return run


for _name in PARAMS:
    register(_name, PARAM_SQL[_name])(_param_query(_name))


# --- batched requests (D4) ------------------------------------------------
def _long(rid: str, cities: list[str], dfrom: str | None, dto: str | None,
          metric: str, pos: int, agg: str) -> str:
    where = ["TRUE"]
    if cities:
        where.append("city_id IN (" + ", ".join(f"'{c}'" for c in cities) + ")")
    if dfrom:
        where.append(f"date >= DATE '{dfrom}'")
    if dto:
        where.append(f"date <= DATE '{dto}'")
    return (f"SELECT '{rid}' AS request_id, city_id, city_name, country, {O.D('date')} AS date, "
            f"'{metric}' AS metric, {pos} AS metric_pos, '{agg}' AS agg, "
            f"{O.R(f'{agg}({metric})')} AS value FROM hourly WHERE {' AND '.join(where)} "
            "GROUP BY city_id, city_name, country, date")


@register("batched_requests", O.with_(O.HOURLY) + " " + " UNION ALL ".join([
    _long("r1", ["c1", "c2"], "2024-01-02", "2024-01-10", "temperature_2m", 0, "avg"),
    _long("r2", [], None, None, "wind_speed_10m", 0, "max"),
    _long("r2", [], None, None, "temperature_2m", 1, "max"),
    _long("r3", ["c5"], None, "2024-01-09", "relative_humidity_2m", 0, "min"),
]))
def q_batched_requests(spark, sf_dir):
    """Three requests answered in one job; equals three single runs."""
    out = batched.batched_query(V.bronze(spark, sf_dir), V.requests(spark))
    return out.withColumn("metric_pos", F.col("metric_pos").cast("int"))


@register("batched_requests_orders", O.with_(O.HOURLY) + f"""
, req AS (
  SELECT concat('o', CAST(o_orderkey AS VARCHAR)) AS request_id,
         concat('c', CAST(o_custkey AS VARCHAR)) AS city_id,
         DATE '2024-01-01' + CAST(o_orderkey % 20 AS INTEGER) AS dfrom,
         DATE '2024-01-01' + CAST(o_orderkey % 20 AS INTEGER) + 7 AS dto,
         CASE o_orderstatus WHEN 'F' THEN ['temperature_2m']
              WHEN 'O' THEN ['wind_speed_10m', 'temperature_2m']
              ELSE ['relative_humidity_2m'] END AS metrics,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'max' WHEN '2-HIGH' THEN 'min'
              ELSE 'avg' END AS agg
  FROM orders),
rm AS (
  SELECT request_id, city_id, dfrom, dto, agg, metrics[1] AS metric, 0 AS metric_pos FROM req
  UNION ALL
  SELECT request_id, city_id, dfrom, dto, agg, metrics[2] AS metric, 1 AS metric_pos
  FROM req WHERE len(metrics) >= 2),
j AS (
  SELECT rm.request_id, h.city_id, h.city_name, h.country, h.date, rm.metric, rm.metric_pos, rm.agg,
         CASE rm.metric WHEN 'temperature_2m' THEN h.temperature_2m
              WHEN 'relative_humidity_2m' THEN h.relative_humidity_2m
              ELSE h.wind_speed_10m END AS v
  FROM rm JOIN hourly h ON h.city_id = rm.city_id AND h.date BETWEEN rm.dfrom AND rm.dto)
SELECT request_id, city_id, city_name, country, {O.D('date')} AS date, metric, metric_pos, agg,
       {O.R("CASE agg WHEN 'avg' THEN avg(v) WHEN 'min' THEN min(v) ELSE max(v) END")} AS value
FROM j GROUP BY request_id, city_id, city_name, country, date, metric, metric_pos, agg""")
def q_batched_requests_orders(spark, sf_dir):
    """D4 at volume: one request per order, answered in one job."""
    out = batched.batched_query(V.bronze(spark, sf_dir), V.order_requests(spark, sf_dir))
    return out.withColumn("metric_pos", F.col("metric_pos").cast("int"))


# --- latest values (E3 E4 C6 C7 C9) --------------------------------------
def _latest_sql(where: str = "TRUE") -> str:
    cols = ", ".join(
        f"{O.R(f'arg_max({m}, (hour_ts, fetch_seq)) FILTER (WHERE {m} IS NOT NULL)')} AS {m}"
        for m in ("temperature_2m", "relative_humidity_2m", "wind_speed_10m")
    )
    return (O.with_(O.HOURLY) + f" SELECT city_id, city_name, country, {cols} FROM hourly "
            f"WHERE city_id IS NOT NULL AND city_id <> '' AND {where} "
            "GROUP BY city_id, city_name, country")


@register("latest_by_city", _latest_sql())
def q_latest_by_city(spark, sf_dir):
    """Last non-null value of each metric per city, by (hour, fetch)."""
    return latest.latest_by_city(V.hourly(spark, sf_dir))


SELECTED = ["c1", "c10", "c100"]


@register("latest_by_city_selected",
          _latest_sql("city_id IN (" + ", ".join(f"'{c}'" for c in SELECTED) + ")"))
def q_latest_by_city_selected(spark, sf_dir):
    """Anchored multi-value selector (``c1`` does not match ``c10x``)."""
    from stratus.functions.text import label_match
    h = V.hourly(spark, sf_dir).where(label_match("city_id", SELECTED))
    return latest.latest_by_city(h)


CURRENT_RANKED = O.with_(O.HOURLY) + """
, ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY city_id, city_name, country, floor(fetch_seq / 24)
                            ORDER BY hour_ts DESC, fetch_seq DESC) AS rn,
         max(hour_ts) OVER (PARTITION BY city_id, city_name, country, floor(fetch_seq / 24)) AS last_hour,
         max(fetch_seq) OVER (PARTITION BY city_id, city_name, country, floor(fetch_seq / 24)) AS last_seq
  FROM hourly
),
cur AS (
  SELECT city_id, city_name, country, floor(fetch_seq / 24) AS block, last_seq,
         strftime(last_hour, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts,
         temperature_2m AS temperature_c, relative_humidity_2m AS humidity_pct,
         wind_speed_10m AS wind_ms,
         coalesce(temperature_2m, relative_humidity_2m, wind_speed_10m) IS NOT NULL AS has_current
  FROM ranked WHERE rn = 1
)"""


@register("latest_current_by_city", CURRENT_RANKED + f"""
SELECT city_id, city_name,
       {O.R("arg_max(temperature_c, (ts, last_seq)) FILTER (WHERE temperature_c IS NOT NULL)")} AS temperature_c,
       {O.R("arg_max(humidity_pct, (ts, last_seq)) FILTER (WHERE humidity_pct IS NOT NULL)")} AS humidity_pct,
       {O.R("arg_max(wind_ms, (ts, last_seq)) FILTER (WHERE wind_ms IS NOT NULL)")} AS wind_ms
FROM cur WHERE has_current GROUP BY city_id, city_name""")
def q_latest_current_by_city(spark, sf_dir):
    """Latest current values per city in arrival order."""
    cur = current.current_flat(_envelopes(spark, sf_dir), keep=["_last_seq"])
    return latest.latest_current_by_city(cur, order_by=("ts", "_last_seq"))


@register("city_event_counts", CURRENT_RANKED + """
SELECT city_id, city_name, CASE WHEN country IN ('AF', 'AS') THEN 'na' ELSE country END AS country, count(*) AS events
FROM cur WHERE has_current GROUP BY 1, 2, 3""")
def q_city_event_counts(spark, sf_dir):
    """E5: current events per city; here two regions come without a country
    (null and empty), which counts as ``na``."""
    flat = current.current_flat(_envelopes(spark, sf_dir))
    country = F.when(F.col("country") == "AF", F.lit(None)).when(F.col("country") == "AS", "").otherwise(F.col("country"))
    return metrics.city_event_counts(flat.withColumn("country", country))


@register("messages_per_poll", CURRENT_RANKED + """
SELECT CAST(block AS BIGINT) AS poll,
       CAST(sum(CASE WHEN has_current THEN 2 ELSE 1 END) AS BIGINT) AS messages,
       count(*) AS cities
FROM cur GROUP BY block""")
def q_messages_per_poll(spark, sf_dir):
    """Raw + current messages per poll (2 with a current value, 1 without)."""
    vals = current.current_values(_envelopes(spark, sf_dir), keep=["block"])
    return metrics.messages_per_poll(
        vals.select(F.col("block").cast("bigint").alias("poll"), "has_current")
    )


@register("messages_by_topic", CURRENT_RANKED + f"""
SELECT '{TOPIC_RAW}' AS topic, count(*) AS messages FROM cur
UNION ALL
SELECT '{TOPIC_CURRENT}' AS topic, count(*) AS messages FROM cur WHERE has_current""")
def q_messages_by_topic(spark, sf_dir):
    """Messages produced per topic (every raw event; current when found)."""
    vals = current.current_values(_envelopes(spark, sf_dir))
    return vals.select(
        F.explode(F.when(
            F.col("has_current"),
            F.array(F.lit(TOPIC_RAW), F.lit(TOPIC_CURRENT)),
        ).otherwise(F.array(F.lit(TOPIC_RAW)))).alias("topic")
    ).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


# --- rates (E12 I5) -------------------------------------------------------
@register("event_rate_1m", O.with_(O.CITY_EVENTS) + f"""
SELECT {O.TS("date_trunc('minute', ts)")} AS window_start, city_name,
       {O.R('count(*) / 60.0')} AS rate
FROM city_events GROUP BY date_trunc('minute', ts), city_name""")
def q_event_rate_1m(spark, sf_dir):
    """Events per second in 1-minute windows, by city name."""
    return metrics.event_rate(V.city_events(spark, sf_dir))


@register("event_rate_sliding", O.with_(O.CITY_EVENTS) + f"""
, win AS (
  SELECT city_name, time_bucket(INTERVAL 10 SECOND, ts) - k * INTERVAL '10 seconds' AS ws
  FROM city_events, range(6) AS r(k)
)
SELECT {O.TS('ws')} AS window_start, city_name, {O.R('count(*) / 60.0')} AS rate
FROM win GROUP BY ws, city_name""")
def q_event_rate_sliding(spark, sf_dir):
    """1-minute windows sliding every 10 s (the dashboard refresh)."""
    return metrics.event_rate(V.city_events(spark, sf_dir), slide="10 seconds")


# --- statuses (E6 E7 A10) -------------------------------------------------
@register("status_latest", O.with_(O.STATUSES) + """
SELECT request_id, status, ts, log_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, log_offset DESC) AS rn
  FROM statuses) WHERE rn = 1""")
def q_status_latest(spark, sf_dir):
    """Last status message per request."""
    return latest.latest_status(V.statuses(spark, sf_dir))


ASKED_SQL = """
asked AS (SELECT DISTINCT concat('r', CAST(c_custkey % 250 AS VARCHAR)) AS request_id FROM customer)"""


@register("status_with_pending", O.with_(O.STATUSES, ASKED_SQL) + """
, last AS (
  SELECT request_id, status, ts, log_offset FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, log_offset DESC) AS rn
    FROM statuses) WHERE rn = 1)
SELECT a.request_id, coalesce(l.status, 'pending') AS status, l.ts, l.log_offset
FROM asked a LEFT JOIN last l ON a.request_id = l.request_id""")
def q_status_with_pending(spark, sf_dir):
    """Asked ids without any message are ``pending``."""
    asked = V.read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("r"), (F.col("c_custkey") % 250).cast("string")).alias("request_id")
    )
    return latest.latest_status(V.statuses(spark, sf_dir), asked=asked)


@register("status_rollup", O.with_(O.TASK_STATES) + """
, one AS (
  SELECT run_id, task, state FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, task
                                 ORDER BY pk DESC, coalesce(state, '') DESC) AS rn
    FROM task_states) WHERE rn = 1)
SELECT run_id,
       CASE WHEN bool_and(coalesce(state, 'unknown') = 'success') THEN 'success' ELSE 'error' END AS status,
       string_agg(task || '=' || coalesce(state, 'unknown'), ',' ORDER BY task) AS upstream
FROM one GROUP BY run_id""")
def q_status_rollup(spark, sf_dir):
    """Run outcome and sorted upstream state map (shown as text)."""
    r = latest.status_rollup(V.task_states(spark, sf_dir))
    return r.select("run_id", "status", latest.map_text("upstream").alias("upstream"))


# --- labelled series (E13 E10 E11) ----------------------------------------
@register("sum_latest_by_labels", O.with_(O.SAMPLES) + f"""
SELECT consumergroup, topic, {O.R('sum(value)')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, consumergroup, topic, part
                               ORDER BY ts DESC, seq DESC) AS rn
  FROM samples) WHERE rn = 1
GROUP BY consumergroup, topic""")
def q_sum_latest_by_labels(spark, sf_dir):
    """``sum(lag) by (consumergroup, topic)`` over the latest samples."""
    return metrics.sum_latest(
        V.samples(spark, sf_dir), series=["metric", "consumergroup", "topic", "part"],
        by=["consumergroup", "topic"],
    )


@register("targets_up", f"""
WITH up AS (
  SELECT 'up' AS metric, concat('target-', CAST(user_id AS VARCHAR)) AS target, ts,
         event_id AS seq, CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS value
  FROM events)
SELECT {O.R('sum(value)')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, target ORDER BY ts DESC, seq DESC) AS rn
  FROM up) WHERE rn = 1""")
def q_targets_up(spark, sf_dir):
    """E13 with no labels: ``sum(up)`` over each target's latest sample."""
    return metrics.sum_latest(V.up_samples(spark, sf_dir), series=["metric", "target"], by=[])


def _hist_sql() -> str:
    from stratus.schemas import LATENCY_BUCKETS
    cols = []
    for b in LATENCY_BUCKETS:
        name = metrics._bucket_name(b)  # noqa: SLF001
        cond = "sec IS NOT NULL" if b == float("inf") else f"sec <= CAST({b!r} AS DOUBLE)"
        cond = f"reason IS NULL AND {cond}"
        cols.append(f"count_if({cond}) AS {name}")
    return (O.with_(O.FETCH_LOG) + " SELECT kind, count_if(replied) AS calls, count(reason) AS failures, "
            f"{O.R('sum(CASE WHEN reason IS NULL THEN sec END)')} AS sum_sec, " + ", ".join(cols) + " FROM fetch_log GROUP BY kind")


@register("fetch_histogram", _hist_sql())
def q_fetch_histogram(spark, sf_dir):
    """Calls, failures and cumulative latency buckets per kind."""
    return metrics.latency_histogram(V.fetch_log(spark, sf_dir))


@register("fetch_failures", O.with_(O.FETCH_LOG) + """
SELECT kind, reason, count(*) AS failures FROM fetch_log WHERE reason IS NOT NULL
GROUP BY kind, reason""")
def q_fetch_failures(spark, sf_dir):
    """Failures by kind and reason."""
    return metrics.failures_by_reason(V.fetch_log(spark, sf_dir))


# --- registry (C4 C10 H10 H11 H13 G4-G8 D1 D3 B9 B10 E9) -----------------
@register("city_validate", O.with_(O.CITIES) + r"""
SELECT id,
       concat_ws(',',
         CASE WHEN coalesce(id, '') = '' THEN 'id_empty' END,
         CASE WHEN NOT regexp_full_match(coalesce(id, ''), '[a-z0-9][a-z0-9\-]{1,62}[a-z0-9]') THEN 'id_pattern' END,
         CASE WHEN coalesce(length(name), 0) < 1 THEN 'name_empty' END,
         CASE WHEN coalesce(length(country), 0) <> 2 THEN 'country_length' END,
         CASE WHEN NOT coalesce(lat BETWEEN -90 AND 90, FALSE) THEN 'lat_range' END,
         CASE WHEN NOT coalesce(lon BETWEEN -180 AND 180, FALSE) THEN 'lon_range' END
       ) AS violations,
       (coalesce(id, '') <> '' AND regexp_full_match(coalesce(id, ''), '[a-z0-9][a-z0-9\-]{1,62}[a-z0-9]')
        AND coalesce(length(name), 0) >= 1 AND coalesce(length(country), 0) = 2
        AND coalesce(lat BETWEEN -90 AND 90, FALSE) AND coalesce(lon BETWEEN -180 AND 180, FALSE)) AS valid
FROM cities""")
def q_city_validate(spark, sf_dir):
    """Rule violations per registry row."""
    v = cities.validate(V.cities(spark, sf_dir))
    return v.select("id", F.array_join("violations", ",").alias("violations"), "valid")


@register("city_slugs", O.with_(O.CITIES) + r"""
SELECT id,
       trim(regexp_replace(regexp_replace(regexp_replace(
         lower(trim(concat_ws('-', name, nullif(country, '')))), '\s+', '-', 'g'),
         '[^a-z0-9\-]+', '', 'g'), '-{2,}', '-', 'g'), '-') AS registry_slug,
       coalesce(nullif(trim(regexp_replace(regexp_replace(lower(name),
         '[^a-z0-9\-]+', '-', 'g'), '-+', '-', 'g'), '-'), ''), 'na') AS event_slug,
       trim(translate(lower(concat(name, ' ', country)), ' _/', '---'), '-') AS ui_slug
FROM cities""")
def q_city_slugs(spark, sf_dir):
    """The three slug forms (registry id default, event, UI)."""
    from stratus.functions.text import slug_event, slug_ui
    c = V.cities(spark, sf_dir)
    return c.select(
        "id",
        cities.created_id().alias("registry_slug"),
        slug_event("name").alias("event_slug"),
        slug_ui(F.concat("name", F.lit(" "), "country")).alias("ui_slug"),
    )


REG_COLS = f"id, name, country, {O.R('lat')} AS lat, {O.R('lon')} AS lon, active"


@register("city_upsert", O.with_(O.CITIES, O.CHANGES) + f"""
SELECT {REG_COLS} FROM cities WHERE id NOT IN (SELECT id FROM changes)
UNION ALL SELECT {REG_COLS} FROM changes""")
def q_city_upsert(spark, sf_dir):
    """Replace by id, else append."""
    return cities.upsert(V.cities(spark, sf_dir), V.changes(spark, sf_dir))


@register("city_update", O.with_(O.CITIES, O.CHANGES) + f"""
, accepted AS (SELECT * FROM changes WHERE id IN (SELECT id FROM cities))
SELECT {REG_COLS} FROM cities WHERE id NOT IN (SELECT id FROM accepted)
UNION ALL SELECT {REG_COLS} FROM accepted""")
def q_city_update(spark, sf_dir):
    """Only existing ids are updated."""
    reg, _ = cities.update_existing(V.cities(spark, sf_dir), V.changes(spark, sf_dir))
    return reg


@register("city_update_rejected", O.with_(O.CITIES, O.CHANGES) + """
SELECT id, 'city not found' AS error FROM changes WHERE id NOT IN (SELECT id FROM cities)""")
def q_city_update_rejected(spark, sf_dir):
    """D3: updates of unknown ids are rejected."""
    _, rej = cities.update_existing(V.cities(spark, sf_dir), V.changes(spark, sf_dir))
    return rej.select("id", "error")


@register("city_delete", O.with_(O.CITIES, O.CHANGES) + f"""
SELECT {REG_COLS} FROM cities WHERE id NOT IN (SELECT id FROM changes)""")
def q_city_delete(spark, sf_dir):
    """Delete by id."""
    reg, _ = cities.delete(V.cities(spark, sf_dir), V.changes(spark, sf_dir).select("id"))
    return reg


@register("city_delete_rejected", O.with_(O.CITIES, O.CHANGES) + """
SELECT id, 'city not found' AS error FROM changes WHERE id NOT IN (SELECT id FROM cities)""")
def q_city_delete_rejected(spark, sf_dir):
    """D3: deletes of unknown ids are rejected."""
    _, rej = cities.delete(V.cities(spark, sf_dir), V.changes(spark, sf_dir).select("id"))
    return rej.select("id", "error")


@register("city_toggle", O.with_(O.CITIES) + f"""
SELECT id, name, country, {O.R('lat')} AS lat, {O.R('lon')} AS lon,
       CASE WHEN country = 'AS' THEN NOT coalesce(active, TRUE) ELSE active END AS active
FROM cities""")
def q_city_toggle(spark, sf_dir):
    """Flip the active flag of the chosen cities."""
    c = V.cities(spark, sf_dir)
    reg, _ = cities.toggle(c, c.where(F.col("country") == "AS").select("id"))
    return reg


@register("city_change_log", O.with_(O.CITIES, O.CHANGES) + """
SELECT id, change_seq, 1 + row_number() OVER (ORDER BY change_seq) AS version
FROM changes WHERE id IN (SELECT id FROM cities)""")
def q_city_change_log(spark, sf_dir):
    """One version per accepted change, in change order (base version 1)."""
    c = V.cities(spark, sf_dir)
    accepted = V.changes(spark, sf_dir).join(c.select("id"), "id", "left_semi")
    log = cities.change_log(1, accepted.select("id", "change_seq"))
    return log.select("id", "change_seq", F.col("version").cast("bigint").alias("version"))


@register("city_apply_changes", O.with_(O.CITIES, O.APPLIED) + f"""
SELECT s.id, name, country, {O.R('lat')} AS lat, {O.R('lon')} AS lon,
       CASE WHEN coalesce(f.n, 0) % 2 = 1 THEN NOT coalesce(active, TRUE) ELSE active END AS active
FROM state s LEFT JOIN flips f ON f.id = s.id""")
def q_city_apply_changes(spark, sf_dir):
    """G4-G7 in order: mixed operations, several per id."""
    reg, _, _ = cities.apply_changes(V.cities(spark, sf_dir), V.mixed_changes(spark, sf_dir))
    return reg


@register("city_changes_rejected", O.with_(O.CITIES, O.APPLIED) + """
SELECT id, seq, fine AS was_valid FROM judged WHERE NOT fine OR (op <> 'create' AND NOT there)""")
def q_city_changes_rejected(spark, sf_dir):
    """Refused changes."""
    _, _, rej = cities.apply_changes(V.cities(spark, sf_dir), V.mixed_changes(spark, sf_dir))
    return rej.select("id", "seq", (F.col("error") == "city not found").alias("was_valid"))


@register("city_change_versions", O.with_(O.CITIES, O.APPLIED) + """
SELECT id, seq, 1 + row_number() OVER (ORDER BY seq, op, id) AS version FROM ok""")
def q_city_change_versions(spark, sf_dir):
    """G8 in use: every accepted change raises the document's version by one."""
    _, acc, _ = cities.apply_changes(V.cities(spark, sf_dir), V.mixed_changes(spark, sf_dir))
    log = cities.global_row_number(acc, ["seq", "op", "id"], "pos")
    return log.select("id", "seq", (F.lit(1) + F.col("pos")).cast("bigint").alias("version"))


@register("lineitem_positions", """
SELECT l_orderkey, l_linenumber, l_comment_chars,
       row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                   l_quantity, l_extendedprice) AS pos
FROM (SELECT *, length(l_returnflag) + l_quantity AS l_comment_chars FROM lineitem)""")
def q_lineitem_positions(spark, sf_dir):
    """G8 at volume: a global position over a table with heavy ties."""
    li = V.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        (F.length("l_returnflag") + F.col("l_quantity")).alias("l_comment_chars"))
    out = cities.global_row_number(li, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                        "l_quantity", "l_extendedprice"], "pos")
    return out.select("l_orderkey", "l_linenumber", "l_comment_chars", F.col("pos").cast("bigint").alias("pos"))


NOW_REQ = """
now_req AS (SELECT event_id, concat(' C', CAST(user_id AS VARCHAR), ' ') AS city_id FROM events)"""

ACTIVE_SQL = """
active AS (
  SELECT coalesce(nullif(trim(regexp_replace(regexp_replace(lower(id), '[^a-z0-9\\-]+', '-', 'g'),
                  '-+', '-', 'g'), '-'), ''), 'na') AS id,
         coalesce(nullif(name, ''), id) AS name,
         coalesce(nullif(country, ''), 'na') AS country, lat, lon
  FROM cities WHERE coalesce(active, TRUE))"""


def _now_requests(spark, sf_dir):
    ev = V.read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.concat(F.lit(" C"), F.col("user_id").cast("string"), F.lit(" ")).alias("city_id"),
    )


@register("now_lookup", O.with_(O.CITIES, NOW_REQ, ACTIVE_SQL) + f"""
SELECT r.event_id, a.id AS city_id, a.name, a.country, {O.R('a.lat')} AS lat, {O.R('a.lon')} AS lon
FROM now_req r JOIN active a ON lower(trim(r.city_id)) = a.id""")
def q_now_lookup(spark, sf_dir):
    """On-demand fetch requests resolved to active cities."""
    found, _ = cities.lookup(_now_requests(spark, sf_dir), V.cities(spark, sf_dir))
    return found.select("event_id", "city_id", "name", "country", "lat", "lon")


@register("now_unknown", O.with_(O.CITIES, NOW_REQ, ACTIVE_SQL) + """
SELECT event_id, lower(trim(city_id)) AS city_id FROM now_req
WHERE lower(trim(city_id)) NOT IN (SELECT id FROM active)""")
def q_now_unknown(spark, sf_dir):
    """Requested ids with no active city (logged and skipped)."""
    _, unknown = cities.lookup(_now_requests(spark, sf_dir), V.cities(spark, sf_dir))
    return unknown.select("event_id", "city_id")


@register("active_cities", O.with_(O.CITIES, ACTIVE_SQL) + f"""
SELECT id, name, country, {O.R('lat')} AS lat, {O.R('lon')} AS lon FROM active""")
def q_active_cities(spark, sf_dir):
    """The fetch list (active, event-slug ids, defaults)."""
    return cities.active_for_fetch(V.cities(spark, sf_dir))


@register("registry_counts", O.with_(O.CITIES) + """
SELECT count(id) AS cities, count_if(coalesce(active, TRUE)) AS active_cities, 1 AS version
FROM cities""")
def q_registry_counts(spark, sf_dir):
    """City count, active count, document version."""
    reg = V.cities(spark, sf_dir).withColumn("version", F.lit(1))
    return cities.registry_counts(reg)


@register("registry_listing", O.with_(O.CITIES) + """
SELECT id, name, country, printf('%.4f', lat) AS lat, printf('%.4f', lon) AS lon,
       CASE WHEN coalesce(active, TRUE) THEN 'active' ELSE 'inactive' END AS status
FROM cities""")
def q_registry_listing(spark, sf_dir):
    """Registry as listed to users."""
    return cities.listing(V.cities(spark, sf_dir))


@register("city_choices", O.with_(O.HOURLY) + """
SELECT DISTINCT city_id FROM hourly WHERE city_id IS NOT NULL""")
def q_city_choices(spark, sf_dir):
    """Selector choices (cities that reported)."""
    return metrics.choices(V.hourly(spark, sf_dir), "city_id")


@register("default_city_choice", O.with_(O.GAPPY) + """
SELECT id FROM gappy WHERE id IS NOT NULL ORDER BY position LIMIT 1""")
def q_default_city_choice(spark, sf_dir):
    """The selector's default, the registry's first city; the limit is the
    feature."""
    return metrics.default_choice(V.gappy_cities(spark, sf_dir), "id", order_col="position")


@register("producer_failures", f"""
SELECT CASE WHEN user_id % 2 = 0 THEN '{TOPIC_RAW}' ELSE '{TOPIC_CURRENT}' END AS topic,
       concat('P', CAST(event_id % 4 AS VARCHAR)) AS reason, count(*) AS failures
FROM events WHERE event_type = 'error' GROUP BY 1, 2""")
def q_producer_failures(spark, sf_dir):
    """Failed sends by topic and reason."""
    return metrics.producer_failures(V.producer_log(spark, sf_dir))


@register("city_validate_gaps", O.with_(O.GAPPY) + r"""
, d AS (SELECT *, coalesce(nullif(id, ''), trim(regexp_replace(regexp_replace(regexp_replace(
         lower(trim(concat_ws('-', name, nullif(country, '')))), '\s+', '-', 'g'),
         '[^a-z0-9\-]+', '', 'g'), '-{2,}', '-', 'g'), '-')) AS full_id FROM gappy)
SELECT position, full_id AS id,
       concat_ws(',',
         CASE WHEN full_id = '' THEN 'id_empty' END,
         CASE WHEN NOT regexp_full_match(full_id, '[a-z0-9][a-z0-9\-]{1,62}[a-z0-9]') THEN 'id_pattern' END,
         CASE WHEN coalesce(length(name), 0) < 1 THEN 'name_empty' END,
         CASE WHEN coalesce(length(country), 0) <> 2 THEN 'country_length' END,
         CASE WHEN NOT coalesce(lat BETWEEN -90 AND 90, FALSE) THEN 'lat_range' END,
         CASE WHEN NOT coalesce(lon BETWEEN -180 AND 180, FALSE) THEN 'lon_range' END) AS violations
FROM d""")
def q_city_validate_gaps(spark, sf_dir):
    """C10/H13 with every rule broken by some row."""
    v = cities.validate(V.gappy_cities(spark, sf_dir))
    return v.select("position", "id", F.array_join("violations", ",").alias("violations"))


@register("active_cities_gaps", O.with_(O.GAPPY) + f"""
SELECT s.id, coalesce(nullif(name, ''), s.id) AS name, coalesce(nullif(country, ''), 'na') AS country,
       {O.R('lat')} AS lat, {O.R('lon')} AS lon
FROM (SELECT *, coalesce(nullif(trim(regexp_replace(regexp_replace(lower(g.id), '[^a-z0-9\\-]+', '-', 'g'),
                  '-+', '-', 'g'), '-'), ''), 'na') AS slug FROM gappy g) t,
     LATERAL (SELECT t.slug AS id) s
WHERE coalesce(active, TRUE)""")
def q_active_cities_gaps(spark, sf_dir):
    """C4/H11/H14 where flags, names and countries are missing."""
    return cities.active_for_fetch(V.gappy_cities(spark, sf_dir))


@register("city_create", O.with_(O.CITIES) + r"""
, created AS (
  SELECT trim(regexp_replace(regexp_replace(regexp_replace(
           lower(trim(concat_ws('-', name, nullif(lower(country), '')))), '\s+', '-', 'g'),
           '[^a-z0-9\-]+', '', 'g'), '-{2,}', '-', 'g'), '-') AS id,
         name, upper(country) AS country, lat, lon, coalesce(active, TRUE) AS active
  FROM cities WHERE country = 'AM' AND lat BETWEEN -90 AND 90)""" + f"""
SELECT {REG_COLS} FROM cities WHERE id NOT IN (SELECT id FROM created)
UNION ALL SELECT {REG_COLS} FROM created""")
def q_city_create(spark, sf_dir):
    """create = id from name-country (given id ignored), upper country."""
    c = V.cities(spark, sf_dir)
    new = c.where(F.col("country") == "AM").withColumn("country", F.lower("country"))
    return cities.create(c, new)


# --- charts, gold presence, de-dup (B8 A17 G3) ---------------------------
def _daily_sql_cte() -> str:
    return O.with_(O.HOURLY) + """
, daily AS (
  SELECT city_id, city_name, country, date,
         avg(temperature_2m) AS avg_temperature_2m, min(temperature_2m) AS min_temperature_2m,
         max(temperature_2m) AS max_temperature_2m,
         avg(relative_humidity_2m) AS avg_relative_humidity_2m,
         avg(wind_speed_10m) AS avg_wind_speed_10m
  FROM hourly GROUP BY city_id, city_name, country, date)"""


@register("chart_series", _daily_sql_cte() + " " + " UNION ALL ".join(
    f"SELECT city_id, {O.D('date')} AS date, '{c}' AS series, {O.R(c)} AS value FROM daily"
    for c in ("avg_temperature_2m", "min_temperature_2m", "max_temperature_2m",
              "avg_relative_humidity_2m", "avg_wind_speed_10m")))
def q_chart_series(spark, sf_dir):
    """One chart series per aggregate column."""
    return metrics.chart_series(daily.daily_aggregate(V.bronze(spark, sf_dir)))


PRESENCE_DAY = "2024-01-15"


@register("partition_presence", _daily_sql_cte() + f"""
SELECT '{PRESENCE_DAY}' AS date, count(*) AS n_rows, count(*) > 0 AS present
FROM daily WHERE date = DATE '{PRESENCE_DAY}'""")
def q_partition_presence(spark, sf_dir):
    """Rows of one day in the gold table."""
    return daily.partition_presence(daily.daily_aggregate(V.bronze(spark, sf_dir)), PRESENCE_DAY)


@register("hourly_dedup", O.with_(O.HOURLY) + f"""
SELECT {BRONZE_COLS}, fetch_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY city_id, hour_ts ORDER BY fetch_seq DESC) AS rn
  FROM hourly) WHERE rn = 1""")
def q_hourly_dedup(spark, sf_dir):
    """Last fetch per (city, hour)."""
    return dedup.last_fetch(V.hourly(spark, sf_dir))


# --- written and read back through the real sinks and readers --------------
def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


@register("gold_round_trip", _daily_sql_cte() + f"""
SELECT city_id, city_name, country, {O.D('date')} AS date, {O.R('avg_temperature_2m')} AS avg_temperature_2m,
       {O.R('min_temperature_2m')} AS min_temperature_2m, {O.R('max_temperature_2m')} AS max_temperature_2m,
       {O.R('avg_relative_humidity_2m')} AS avg_relative_humidity_2m, {O.R('avg_wind_speed_10m')} AS avg_wind_speed_10m
FROM daily""")
def q_gold_round_trip(spark, sf_dir):
    """Bronze written by date and read back, aggregated, written day by
    day over an older run, and read back."""
    base = _folder(spark, "gold")
    V.bronze(spark, sf_dir).write.partitionBy("date").parquet(f"{base}/bronze")
    gold = daily.daily_aggregate(read_bronze(spark, f"{base}/bronze"))
    daily.write_daily(gold.withColumn("avg_wind_speed_10m", F.lit(-1.0)), f"{base}/gold")
    daily.write_daily(gold, f"{base}/gold", mode="dynamic")
    return read_parquet_or_empty(spark, f"{base}/gold", GOLD_DDL)


@register("stored_day_presence", _daily_sql_cte() + f"""
SELECT '{PRESENCE_DAY}' AS date, count(*) AS n_rows, count(*) > 0 AS present
FROM daily WHERE date = DATE '{PRESENCE_DAY}'""")
def q_stored_day_presence(spark, sf_dir):
    """A17 over a stored gold table: one day's footers are read, no row."""
    base = _folder(spark, "presence")
    daily.write_daily(daily.daily_aggregate(V.bronze(spark, sf_dir)), base)
    return stored_day_presence(spark, base, PRESENCE_DAY)


@register("result_round_trip", PARAM_SQL["param_avg"])
def q_result_round_trip(spark, sf_dir):
    """A request's result folder written and read back."""
    base = _folder(spark, "result")
    p = paramquery.resolve(PARAMS["param_avg"])
    paramquery.write_result(paramquery.param_query(V.bronze(spark, sf_dir), p, ordered=False), f"{base}/{p.request_id}")
    return read_result(spark, f"{base}/{p.request_id}")


@register("registry_round_trip", O.with_(O.CITIES) + f"""
SELECT 7 AS version, 'tests' AS updated_by, {REG_COLS} FROM cities""")
def q_registry_round_trip(spark, sf_dir):
    """A registry version written and read back."""
    base = _folder(spark, "registry")
    write_registry(V.cities(spark, sf_dir), base, 7, "tests")
    return read_registry_version(spark, base, 7).drop("updated_at")


@register("registry_chain", O.with_(O.CITIES, O.APPLIED) + f"""
SELECT state.id, name, country, {O.R('lat')} AS lat, {O.R('lon')} AS lon,
       CASE WHEN coalesce(n, 0) % 2 = 1 THEN NOT coalesce(active, TRUE) ELSE active END AS active,
       CAST(7 + (SELECT count(*) FROM ok) AS INTEGER) AS version, 'tests' AS updated_by
FROM state LEFT JOIN flips ON flips.id = state.id""")
def q_registry_chain(spark, sf_dir):
    """Three batches of changes, each applied to the version that the
    one before wrote, give the one ordered fold; versions go on through them."""
    root = _folder(spark, "registry-chain")
    start = registry.open_registry(spark, f"{root}/none")
    registry.commit(spark, start, V.cities(spark, sf_dir), root, 6, "import")
    ops = V.mixed_changes(spark, sf_dir)
    for lo, hi in ((0, 2), (3, 5), (6, 9)):
        done = registry.apply_batch(spark, root, ops.where((F.col("seq") % 10).between(lo, hi)), root, "tests")
    return done.snapshot.table.drop("updated_at")


@register("status_log_order", """
WITH log AS (
  SELECT concat('q', CAST(o_custkey % 300 AS VARCHAR)) AS request_id, o_orderkey,
         CASE o_orderkey % 3 WHEN 0 THEN 'submitted' WHEN 1 THEN 'done' ELSE 'ERROR' END AS word
  FROM orders),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY o_orderkey DESC) AS rn FROM log)
  WHERE rn = 1)
SELECT request_id, CASE lower(word) WHEN 'done' THEN 'success' ELSE lower(word) END AS status, o_orderkey AS seq
FROM last""")
def q_status_log_order(spark, sf_dir):
    """A broker log whose messages carry misleading clocks (all equal,
    some epoch and some ISO): the log's own order decides."""
    o = V.read_table(spark, sf_dir, "orders")
    clock = F.when(F.col("o_orderkey") % 2 == 0, "1704067200").otherwise("2024-01-01T00:00:00Z")
    word = (F.when(F.col("o_orderkey") % 3 == 0, "submitted").when(F.col("o_orderkey") % 3 == 1, "done")
            .otherwise("ERROR"))
    log = o.select(
        F.to_json(F.struct(F.concat(F.lit("q"), (F.col("o_custkey") % 300).cast("string")).alias("request_id"),
                           word.alias("status"), clock.alias("ts"))).alias("value"),
        F.timestamp_seconds(F.col("o_orderkey")).alias("timestamp"), F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"))
    last = latest.latest_status(parse_statuses(log), order_by=("log_offset",))
    return last.select("request_id", "status", F.col("log_offset.offset").alias("seq"))


# --- whole days in one event: 24-element arrays, current values, no values ---
@register("day_flatten", O.with_(O.DAY_EVENTS) + f"""
SELECT event_id, city_id, city_name, country, {O.TS('hour_ts')} AS hour_ts, {O.R('temperature_2m')} AS temperature_2m,
       {O.R('relative_humidity_2m')} AS relative_humidity_2m, {O.R('wind_speed_10m')} AS wind_speed_10m,
       {O.D('hour_ts')} AS date, ingested_at
FROM day_hours""")
def q_day_flatten(spark, sf_dir):
    """24 hours per event, with null elements."""
    return flatten.flatten(V.day_events(spark, sf_dir), keep_ingested_at=True, keep=["event_id"])


@register("day_current", O.with_(O.DAY_EVENTS) + f"""
SELECT event_id, city_id, city_name, country, ts, {O.R('temperature_c')} AS temperature_c,
       {O.R('humidity_pct')} AS humidity_pct, {O.R('wind_ms')} AS wind_ms, 'open-meteo' AS source
FROM day_current WHERE has_current""")
def q_day_current(spark, sf_dir):
    """Given current values, fallbacks per metric, events without any."""
    return current.current_flat(V.day_events(spark, sf_dir), keep=["event_id"])


@register("day_messages_per_poll", O.with_(O.DAY_EVENTS) + """
SELECT event_id % 50 AS poll, CAST(sum(CASE WHEN has_current THEN 2 ELSE 1 END) AS BIGINT) AS messages,
       count(*) AS cities
FROM day_current GROUP BY 1""")
def q_day_messages_per_poll(spark, sf_dir):
    """E8 where some events have no current value."""
    vals = current.current_values(V.day_events(spark, sf_dir), keep=["event_id"])
    return metrics.messages_per_poll(vals.select((F.col("event_id") % 50).alias("poll"), "has_current"))


@register("day_latest_by_city", O.with_(O.DAY_EVENTS) + f"""
SELECT city_id, city_name, country,
       {O.R('arg_max(temperature_2m, (hour_ts, event_id)) FILTER (WHERE temperature_2m IS NOT NULL)')} AS temperature_2m,
       {O.R('arg_max(relative_humidity_2m, (hour_ts, event_id)) FILTER (WHERE relative_humidity_2m IS NOT NULL)')} AS relative_humidity_2m,
       {O.R('arg_max(wind_speed_10m, (hour_ts, event_id)) FILTER (WHERE wind_speed_10m IS NOT NULL)')} AS wind_speed_10m
FROM day_hours WHERE city_id <> '' GROUP BY city_id, city_name, country""")
def q_day_latest_by_city(spark, sf_dir):
    """Empty city ids and null values are passed over; the same hour
    comes many times, the last event decides."""
    h = flatten.flatten(V.day_events(spark, sf_dir), keep=["event_id"])
    return latest.latest_by_city(h, order_by=("hour_ts", "event_id"))


# --- single steps with a row of their own (A9 C8 D2 H12 H19) -------------------
@register("published_requests", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'generated' ELSE concat('o', CAST(o_orderkey AS VARCHAR)) END AS request_id,
       concat('c', CAST(o_custkey AS VARCHAR)) AS city_ids,
       CASE WHEN o_orderkey % 5 = 0 THEN 'temperature_2m' WHEN o_orderstatus = 'F' THEN 'temperature_2m'
            WHEN o_orderstatus = 'O' THEN 'wind_speed_10m,temperature_2m' ELSE 'relative_humidity_2m' END AS metrics,
       CASE WHEN o_orderkey % 3 = 0 THEN 'avg' WHEN o_orderpriority = '1-URGENT' THEN 'max'
            WHEN o_orderpriority = '2-HIGH' THEN 'min' ELSE 'avg' END AS agg, 'tests' AS submitted_by
FROM orders""")
def q_published_requests(spark, sf_dir):
    """One request per order, some without id, metrics or aggregate: ids are
    generated (36 characters, all different), the rest takes the defaults."""
    key = F.substring("request_id", 2, 20).cast("long")
    asked = V.order_requests(spark, sf_dir).withColumn("key", key).select(
        F.when(key % 7 != 0, F.col("request_id")).alias("request_id"),
        F.concat(F.array(key.cast("string")), "city_ids").alias("city_ids"), "date_from", "date_to",
        F.when(key % 5 != 0, F.col("metrics")).alias("metrics"), F.when(key % 3 != 0, F.col("agg")).alias("agg"))
    sent = publish_requests(asked, "tests")
    made = (F.length("request_id") == 36) & (F.count("*").over(Window.partitionBy("request_id")) == 1)
    return sent.select(
        F.col("city_ids")[0].cast("long").alias("o_orderkey"), F.when(made, "generated").otherwise(F.col("request_id")).alias("request_id"),
        F.col("city_ids")[1].alias("city_ids"), F.array_join("metrics", ",").alias("metrics"), "agg", "submitted_by")


@register("attached_cities", SQL["hourly_flatten"])
def q_attached_cities(spark, sf_dir):
    """Replies without names get the registry's, become raw events, and flatten to
    the hourly rows."""
    replies = envelope.replies_from_hourly(V.hourly(spark, sf_dir)).drop("city_name", "country")
    return flatten.flatten(envelope.envelope(envelope.attach_city(replies, V.cities(spark, sf_dir))))


@register("status_of_one", """
SELECT concat('r', CAST(o_custkey % 200 AS VARCHAR)) AS request_id,
       CASE o_orderstatus WHEN 'O' THEN 'submitted' WHEN 'F' THEN 'success' ELSE 'error' END AS status
FROM orders WHERE o_custkey % 200 = 7 ORDER BY o_orderkey DESC LIMIT 1""")
def q_status_of_one(spark, sf_dir):
    """The last status of one request in the whole log."""
    return status_of(spark, V.statuses(spark, sf_dir), "r7").select("request_id", "status")


@register("status_clocks", """
WITH log AS (
  SELECT concat('q', CAST(o_custkey % 300 AS VARCHAR)) AS request_id, o_orderkey, o_orderdate,
         CASE o_orderkey % 3 WHEN 0 THEN 'submitted' WHEN 1 THEN 'success' ELSE 'error' END AS status
  FROM orders)
SELECT request_id, status, CAST(o_orderkey AS BIGINT) AS log_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM log)
WHERE rn = 1""")
def q_status_clocks(spark, sf_dir):
    """Half of the messages carry epoch seconds (some as decimals), half ISO text;
    the clock decides, and the log where clocks agree."""
    o = V.read_table(spark, sf_dir, "orders")
    at, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    clock = (F.when(k % 4 == 0, F.unix_seconds(at).cast("string"))
             .when(k % 4 == 1, F.concat(F.unix_seconds(at).cast("string"), F.lit(".0")))
             .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    word = F.when(k % 3 == 0, "submitted").when(k % 3 == 1, "success").otherwise("error")
    log = o.select(F.concat(F.lit("q"), (F.col("o_custkey") % 300).cast("string")).alias("request_id"),
                   word.alias("status"), clock.alias("ts"), k.cast("long").alias("log_offset"))
    return latest.latest_status(log).select("request_id", "status", "log_offset")


@register("result_paths", """
SELECT o_orderkey, concat('lake/q/', rid) AS plain,
       concat('lake/q/request_id=', replace(replace(replace(rid, '%', '%25'), ':', '%3A'), '/', '%2F')) AS keyed
FROM (SELECT o_orderkey, concat('2025-01-01T', CAST(o_orderkey % 24 AS VARCHAR), ':00/', CAST(o_custkey AS VARCHAR), '%') AS rid
      FROM orders)""")
def q_result_paths(spark, sf_dir):
    """Result folders of ids with characters that a partition folder escapes."""
    rid = F.concat(F.lit("2025-01-01T"), (F.col("o_orderkey") % 24).cast("string"), F.lit(":00/"),
                   F.col("o_custkey").cast("string"), F.lit("%"))
    return V.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", result_path("lake/q/", rid).alias("plain"), result_path("lake/q", rid, "request_id").alias("keyed"))
