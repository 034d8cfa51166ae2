"""Column -> Column helpers built from pyspark.sql.functions only."""

from stratus.functions.arrays import keep_known, last_element
from stratus.functions.text import (
    csv_to_list, label_match, list_to_csv, norm_id, result_path, slug_event, slug_registry,
    slug_ui, strip_ws,
)
from stratus.functions.times import epoch_or_iso, hour_key, json_ts, now_iso, parse_hour

__all__ = [
    "csv_to_list", "epoch_or_iso", "hour_key", "json_ts", "keep_known", "label_match",
    "last_element", "list_to_csv", "norm_id", "now_iso", "parse_hour", "result_path", "slug_event",
    "slug_registry", "slug_ui", "strip_ws",
]
