"""Readers and writers: A2 A3 A10 A15 A16 C11 D2 H17 H19, plus the real-data
round trip (hourly -> envelopes -> flatten) on the shared tables."""

import datetime as dt
import json
import os

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from stratus.functions.text import list_to_csv, result_path
from stratus.operators import envelope, flatten
from stratus.operators.daily import MissingColumns
from stratus.plans import views as V
from stratus.sources import files
from stratus.sources.sinks import as_messages, append_json
from stratus.sources.streams import Source, parse_hourly_messages, parse_statuses, read_log


def test_read_result_only_parquet_and_absent(spark, tmp):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0)], "city_id string, date date, avg_t double")
    df.write.parquet(f"{tmp}/r1")
    with open(f"{tmp}/r1/notes.txt", "w") as f:
        f.write("not data")
    assert rows(files.read_result(spark, f"{tmp}/r1")) == [("a", dt.date(2024, 1, 1), 1.0)]
    assert files.read_result(spark, f"{tmp}/missing").count() == 0


def test_read_bronze_guard(spark, tmp):
    h = V.bronze(spark, SF_SMALL)
    h.write.partitionBy("date").parquet(f"{tmp}/b")
    assert files.read_bronze(spark, f"{tmp}/b").count() == h.count()
    h.drop("country").write.parquet(f"{tmp}/bad")
    with pytest.raises(MissingColumns, match="country"):
        files.read_bronze(spark, f"{tmp}/bad")


def test_messages_round_trip(spark, tmp):
    b = V.bronze(spark, SF_SMALL)
    msgs = flatten.hourly_payload(b)
    msgs.write.parquet(f"{tmp}/m")
    back = files.read_hourly_messages(spark, f"{tmp}/m")
    assert back.count() == b.count()
    typed = parse_hourly_messages(spark.read.parquet(f"{tmp}/m"))
    same = typed.select("city_id", F.col("hour_ts"), "temperature_2m").exceptAll(
        b.select("city_id", "hour_ts", "temperature_2m"))
    assert same.count() == 0
    keyed = as_messages(b.limit(3).withColumn("k", F.col("city_id")), key="k")
    assert keyed.columns == ["key", "value"]
    assert "city_id" in json.loads(keyed.first().value)


def test_status_log_reader(spark, tmp):
    os.makedirs(f"{tmp}/s")
    with open(f"{tmp}/s/part-0.json", "w") as f:
        f.write(json.dumps({"request_id": "r", "status": "submitted", "ts": 1735689600.0}) + "\n")
        f.write(json.dumps({"request_id": "r", "status": "success", "ts": "2025-01-01T00:00:05Z",
                            "upstream": {"spark_run_query": "success"}}) + "\n")
    st = files.read_statuses(spark, f"{tmp}/s")
    assert rows(st, "status", "ts_norm") == [("submitted", dt.datetime(2025, 1, 1)),
                                             ("success", dt.datetime(2025, 1, 1, 0, 0, 5))]
    assert files.read_statuses(spark, f"{tmp}/none").count() == 0
    parsed = parse_statuses(read_log(spark, Source("files", path=f"{tmp}/s")))
    assert rows(parsed, "status", "ts_norm") == rows(st, "status", "ts_norm")
    append_json(st.drop("ts_norm", "log_offset"), f"{tmp}/s2")
    assert spark.read.json(f"{tmp}/s2").count() == 2


def test_attach_city(spark):
    replies = spark.createDataFrame([("c1", "old", "XX", 0), ("zz", "?", "?", 1)],
                                    "city_id string, city_name string, country string, block long")
    reg = spark.createDataFrame([("c1", "One", "EU", 1.0, 2.0, True)],
                                "id string, name string, country string, lat double, lon double, active boolean")
    out = envelope.attach_city(replies, reg)
    assert rows(out, "city_id", "city_name", "country") == [("c1", "One", "EU")]


def test_list_helpers(spark):
    df = spark.createDataFrame([(["a", "b"],)], "l array<string>")
    r = df.select(list_to_csv("l").alias("c"), result_path("/gold/q/", F.lit("r1")).alias("p")).first()
    assert (r.c, r.p) == ("a,b", "/gold/q/r1")


def test_round_trip_on_shared_tables(spark):
    """hourly -> envelopes -> flatten == hourly, both ways (exceptAll)."""
    h = V.hourly(spark, SF_SMALL)
    back = flatten.flatten(envelope.envelope(envelope.replies_from_hourly(h)))
    cols = [c for c in h.columns if c != "fetch_seq"]
    assert back.exceptAll(h.select(cols)).count() == 0
    assert h.select(cols).exceptAll(back).count() == 0
