"""DuckDB text of the derived views, and the presentation rules shared by the
Spark queries and their SQL twins.

Presentation (applied to both sides, so results compare exactly):
* doubles are rounded to 4 places after a 1e-9 nudge: sums run in a
  different order in each engine, and an exact decimal tie (x.xxxx5) must
  not round up in one and down in the other;
* timestamps and dates are compared as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUDGE = 1e-9
PLACES = 4


def present(df: DataFrame) -> DataFrame:
    """Spark side of the presentation rules, applied by column type."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(NUDGE), PLACES)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def R(x: str) -> str:
    """SQL side: rounded double."""
    return f"round(({x}) + {NUDGE}, {PLACES})"


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def D(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


CITIES_K = """
cities_k AS (
  SELECT c_custkey AS city_key,
         concat('c', CAST(c_custkey AS VARCHAR)) AS id,
         c_name AS name,
         upper(substr(r_name, 1, 2)) AS country,
         CAST((c_custkey * 37) % 1900 AS DOUBLE) / 10 - 95 AS lat,
         CAST((c_custkey * 53) % 3600 AS DOUBLE) / 10 - 180 AS lon,
         (c_custkey % 5 <> 0) AS active
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

CITIES = CITIES_K + """,
cities AS (SELECT id, name, country, lat, lon, active FROM cities_k)"""

HOURLY = CITIES + """,
hourly AS (
  SELECT c.id AS city_id, c.name AS city_name, c.country,
         date_trunc('hour', e.ts) AS hour_ts,
         CASE WHEN e.event_type = 'error' THEN NULL ELSE e.value END AS temperature_2m,
         TRY_CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS relative_humidity_2m,
         e.value / 10 AS wind_speed_10m,
         CAST(e.ts AS DATE) AS date,
         e.event_id AS fetch_seq
  FROM events e JOIN cities_k c ON c.city_key = e.user_id
)"""

DAY_EVENTS = CITIES_K + """,
day_events AS (
  SELECT e.event_id, CASE WHEN e.event_id % 97 = 0 THEN '' ELSE c.id END AS city_id, c.name AS city_name,
         c.country, date_trunc('day', e.ts) AS day, strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS ingested_at,
         e.value, e.event_type = 'error' AS bad, e.event_id % 3 AS k
  FROM events e JOIN cities_k c ON c.city_key = e.user_id),
day_hours AS (
  SELECT event_id, city_id, city_name, country, CAST(day AS TIMESTAMP) + h * INTERVAL 1 HOUR AS hour_ts, ingested_at,
         CASE WHEN NOT bad AND h % 5 <> 0 THEN value + h END AS temperature_2m,
         CASE WHEN NOT bad THEN CAST(event_id % 100 + h AS DOUBLE) END AS relative_humidity_2m,
         CASE WHEN NOT bad AND h <> 23 THEN value / 10 END AS wind_speed_10m
  FROM day_events, range(24) r(h)),
day_current AS (
  SELECT event_id, city_id, city_name, country, ingested_at AS ts,
         CASE WHEN bad THEN NULL WHEN k < 2 THEN value * 2 ELSE value + 23 END AS temperature_c,
         CASE WHEN bad THEN NULL WHEN k = 0 THEN 55.5 ELSE CAST(event_id % 100 + 23 AS DOUBLE) END AS humidity_pct,
         CASE WHEN NOT bad AND k = 0 THEN 1.25 END AS wind_ms, NOT bad AS has_current
  FROM day_events)"""

STATUSES = """
statuses AS (
  SELECT concat('r', CAST(o_custkey % 200 AS VARCHAR)) AS request_id,
         CASE o_orderstatus WHEN 'O' THEN 'submitted' WHEN 'F' THEN 'success'
              ELSE 'error' END AS status,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ts,
         o_orderkey AS log_offset
  FROM orders
)"""

TASK_STATES = """
task_states AS (
  SELECT l_orderkey AS run_id, concat('t', CAST(l_linenumber AS VARCHAR)) AS task,
         CASE WHEN l_linestatus = 'F' THEN 'success'
              WHEN l_returnflag = 'R' THEN NULL ELSE 'failed' END AS state,
         l_partkey AS pk
  FROM lineitem
)"""

SAMPLES = """
samples AS (
  SELECT 'lag' AS metric, event_type AS consumergroup,
         concat('t', CAST(user_id % 6 AS VARCHAR)) AS topic, user_id AS part,
         ts, event_id AS seq, value
  FROM events
)"""

FETCH_LOG = """
fetch_log AS (
  SELECT event_type AS kind,
         CASE WHEN event_type = 'error'
              THEN concat('E', CAST(user_id % 3 AS VARCHAR)) END AS reason,
         value / 100 AS sec, event_type <> 'error' OR user_id % 3 <> 2 AS replied
  FROM events
)"""

GAPPY = CITIES_K + """,
gappy AS (
  SELECT city_key AS position,
         CASE WHEN city_key % 17 = 0 THEN 'No_' || id WHEN city_key % 19 = 0 THEN '' ELSE id END AS id,
         CASE WHEN city_key % 9 = 0 THEN '' WHEN city_key % 10 = 0 THEN NULL ELSE name END AS name,
         CASE WHEN city_key % 13 = 0 THEN '' WHEN city_key % 14 = 0 THEN 'EUR' ELSE country END AS country,
         CASE WHEN city_key % 15 = 0 THEN NULL ELSE lat END AS lat,
         lon * CASE WHEN city_key % 16 = 0 THEN 3 ELSE 1 END AS lon,
         CASE WHEN city_key % 4 = 1 THEN NULL ELSE active END AS active
  FROM cities_k)"""

CHANGES = """,
changes AS (
  SELECT id, concat(name, ' v2') AS name, country, lat, lon, NOT active AS active,
         city_key * 2 AS change_seq
  FROM cities_k WHERE length(id) % 2 = 0
  UNION ALL
  SELECT concat('n', id) AS id, name, country, lat, lon, active, city_key * 2 + 1 AS change_seq
  FROM cities_k WHERE country = 'EU'
)"""

_SLUG = r"""trim(regexp_replace(regexp_replace(regexp_replace(
  lower(trim(concat_ws('-', name, nullif(country, '')))), '\s+', '-', 'g'),
  '[^a-z0-9\-]+', '', 'g'), '-{2,}', '-', 'g'), '-')"""
_OPS = [
    ("city_key % 3 = 0", "'toggle'", 1, "id", "lat", "country", "name"),
    ("city_key % 6 = 0", "'toggle'", 2, "id", "lat", "country", "name"),
    ("city_key % 4 = 1", "'update'", 3, "id", "lat", "country", "name || ' u'"),
    ("city_key % 4 = 1", "'toggle'", 4, "id", "lat", "country", "name"),
    ("city_key % 5 = 2", "'delete'", 5, "id", "lat", "country", "name"),
    ("city_key % 10 = 2", "'update'", 6, "id", "lat", "country", "name"),
    ("city_key % 7 = 3", "'create'", 1, _SLUG, "1.0", "country", "name"),
    ("city_key % 7 = 3", "'delete'", 2, _SLUG, "lat", "country", "name"),
    ("city_key % 14 = 3", "'create'", 7, _SLUG, "2.0", "country", "name"),
    ("city_key % 14 = 3", "'toggle'", 8, _SLUG, "lat", "country", "name"),
    ("city_key % 11 = 0", "'create'", 9, _SLUG.replace("country", "'xyz'"), "lat", "'XYZ'", "name"),
    ("city_key % 50 = 0", "'toggle'", 9, "concat('ghost', city_key)", "lat", "country", "name"),
]
#: Ordered application of views.mixed_changes: ``judged`` has every change and
#: whether its id exists just before it; ``ok`` the accepted ones.
APPLIED = """,
ops AS (
""" + "\nUNION ALL ".join(
    f"SELECT {op} AS op, city_key * 10 + {at} AS seq, {i} AS id, {n} AS name, {c} AS country, "
    f"CAST({lat} AS DOUBLE) AS lat, lon, active FROM cities_k WHERE {when}"
    for when, op, at, i, lat, c, n in _OPS) + r"""
),
valid AS (
  SELECT *, op NOT IN ('create', 'update') OR (
      regexp_full_match(id, '[a-z0-9][a-z0-9\-]{1,62}[a-z0-9]') AND length(country) = 2
      AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) AS fine
  FROM ops),
judged AS (
  SELECT v.*, coalesce(last_value(CASE WHEN fine AND op IN ('create', 'delete') THEN op = 'create' END IGNORE NULLS)
      OVER (PARTITION BY v.id ORDER BY seq, op ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      v.id IN (SELECT id FROM cities_k)) AS there
  FROM valid v),
ok AS (SELECT * FROM judged WHERE fine AND (op = 'create' OR there)),
setter AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC, op DESC) AS rn
    FROM ok WHERE op <> 'toggle') WHERE rn = 1),
flips AS (
  SELECT ok.id, count(*) AS n FROM ok LEFT JOIN setter s ON s.id = ok.id
  WHERE ok.op = 'toggle' AND (s.seq IS NULL OR ok.seq > s.seq) GROUP BY ok.id),
state AS (
  SELECT id, name, country, lat, lon, active FROM cities_k WHERE id NOT IN (SELECT id FROM setter)
  UNION ALL SELECT id, name, country, lat, lon, active FROM setter WHERE op <> 'delete')"""

CITY_EVENTS = CITIES_K + """,
city_events AS (
  SELECT e.event_id, e.ts, e.event_type, c.id AS city_id, c.name AS city_name, c.country
  FROM events e JOIN cities_k c ON c.city_key = e.user_id
)"""

def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().lstrip(",") for c in ctes)
