"""Data model: DDL strings for every record type, and the closed value sets."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the behaviour being reproduced, so they are
# stated plainly and kept together.
# ---------------------------------------------------------------------------
# The three hourly metrics, in the order the jobs list them.
METRICS = ("temperature_2m", "relative_humidity_2m", "wind_speed_10m")
# Allowed aggregations for a parametric query.
AGGS = ("avg", "min", "max")
# Columns the daily job requires in the hourly (bronze) table.
BRONZE_REQUIRED = (
    "city_id", "city_name", "country", "hour_ts",
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "date",
)
# Request defaults applied when a field is missing or null.
DEFAULT_REQUEST_ID = "no-request-id"
DEFAULT_METRICS = ("temperature_2m",)
DEFAULT_AGG = "avg"
# Days in a request are written like this, and nothing else.
DAY_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# City id rule of the registry, and the bounds of the other fields.
CITY_ID_PATTERN = r"^[a-z0-9][a-z0-9\-]{1,62}[a-z0-9]$"
# Steps of the registry's id slug after lower-casing and trimming (white space
# is Unicode's), in order; then dashes at the ends go.
REGISTRY_SLUG_STEPS = ((r"(?U)\s+", "-"), (r"[^a-z0-9\-]+", ""), (r"-{2,}", "-"))
# Steps of the event slug.
EVENT_SLUG_STEPS = ((r"[^a-z0-9\-]+", "-"), (r"-+", "-"))
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
COUNTRY_LEN = 2
# Text formats: hour key of the hourly message, its JSON time field, the
# hour strings inside raw events, and the ISO "now" stamp.
KEY_HOUR_FORMAT = "yyyyMMddHH"
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RAW_HOUR_FORMAT = "yyyy-MM-dd'T'HH:mm"
ISO_NOW_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
KEY_SEPARATOR = "|"
# Source tag written in raw and current events.
SOURCE_TAG = "open-meteo"
# Request status words; "done" is read as an alias of "success".
STATUSES = ("pending", "submitted", "success", "error")
STATUS_ALIASES = {"done": "success"}
# Task state that counts as success in the run rollup, and the null stand-in.
TASK_SUCCESS = "success"
TASK_UNKNOWN = "unknown"
# Latency histogram bucket bounds (client library defaults, seconds).
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75,
                   1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))
# Column names of the current (flat) observation.
CURRENT_NAMES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_ms",
}
# Prefixes of aggregate columns that become chart series.
SERIES_PREFIXES = ("avg_", "min_", "max_")

# ---------------------------------------------------------------------------
# DDL
# ---------------------------------------------------------------------------
_HOURLY_ARRAYS = (
    "struct<time:array<string>,temperature_2m:array<double>,"
    "relative_humidity_2m:array<double>,wind_speed_10m:array<double>>"
)
# For the current-value fallback the arrays are read as text, so one bad
# element cannot null the whole array.
_HOURLY_ARRAYS_TEXT = (
    "struct<time:array<string>,temperature_2m:array<string>,"
    "relative_humidity_2m:array<string>,wind_speed_10m:array<string>>"
)
META_DDL = "struct<city_id:string,city_name:string,country:string,ingested_at:string>"
CURRENT_DDL = (
    "struct<time:string,temperature_2m:double,relative_humidity_2m:double,"
    "wind_speed_10m:double>"
)

# T2 raw event: the flatten reads _meta and raw.hourly only.
RAW_EVENT_DDL = f"_meta {META_DDL}, raw struct<hourly:{_HOURLY_ARRAYS}>"
# T2 as read by the current extraction: _meta, current and top-level hourly.
RAW_CURRENT_DDL = (
    f"_meta {META_DDL}, source string, current {CURRENT_DDL}, hourly {_HOURLY_ARRAYS_TEXT}"
)

# T3 hourly observation (bronze)
BRONZE_DDL = (
    "city_id string, city_name string, country string, hour_ts timestamp, "
    "temperature_2m double, relative_humidity_2m double, wind_speed_10m double, date date"
)
# The daily aggregate (gold)
GOLD_DDL = (
    "city_id string, city_name string, country string, avg_temperature_2m double, "
    "min_temperature_2m double, max_temperature_2m double, avg_relative_humidity_2m double, "
    "avg_wind_speed_10m double, date date"
)
# T4 hourly message value (JSON); hour_ts is text here.
HOURLY_MESSAGE_DDL = (
    "city_id string, city_name string, country string, hour_ts string, "
    "temperature_2m double, relative_humidity_2m double, wind_speed_10m double"
)
# T5 current observation
CURRENT_OBS_DDL = (
    "city_id string, city_name string, country string, ts string, "
    "temperature_c double, humidity_pct double, wind_ms double, source string"
)
# T1 registry document
CITY_DDL = "id string, name string, country string, lat double, lon double, active boolean"
REGISTRY_DDL = (
    "version int, updated_at string, updated_by string, "
    "cities array<struct<id:string,name:string,country:string,lat:double,lon:double,"
    "active:boolean>>"
)
# T7 query request
REQUEST_DDL = (
    "request_id string, city_ids array<string>, date_from string, date_to string, "
    "metrics array<string>, agg string, submitted_by string, submitted_at string"
)
# T9 request status; ts may be epoch seconds or ISO text.
STATUS_DDL = (
    "request_id string, status string, dag_run_id string, error string, "
    "result_path string, upstream map<string,string>, ts string"
)
# T10 metric sample
SAMPLE_DDL = "metric string, labels map<string,string>, ts timestamp, value double"

