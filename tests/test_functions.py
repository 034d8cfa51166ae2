"""H10-H21 helpers on awkward input: regex metacharacters, quoting, Unicode
whitespace, NULLs."""

from conftest import rows
from pyspark.sql import functions as F

from stratus.functions.arrays import keep_known, last_element
from stratus.functions.text import csv_to_list, label_match, norm_id, strip_ws


def test_label_match_quotes_everything(spark):
    vals = ["a.b", "c+d", r"x\Ey", "(p|q)", "ok"]
    df = spark.createDataFrame([(v,) for v in vals + ["axb", "cd", "p", "q", "xy"]], "v string")
    assert sorted(r.v for r in df.where(label_match("v", vals)).collect()) == sorted(vals)
    assert df.where(label_match("v", [])).count() == df.count()


def test_strip_and_norm_id_match_python(spark):
    samples = ["  a ", "\tb\n", " c　", "  D  ", "", "   ", "e f"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [(r.a, r.b) for r in df.select(strip_ws("s").alias("a"), norm_id("s").alias("b")).collect()]
    assert got == [(s.strip(), s.strip().lower()) for s in samples]


def test_csv_to_list_unicode_spaces(spark):
    df = spark.createDataFrame([("a, b , ,c",), (None,)], "s string")
    assert [r.l for r in df.select(csv_to_list("s").alias("l")).collect()] == [["a", "b", "c"], None]


def test_arrays(spark):
    df = spark.createDataFrame([(["x", "temperature_2m", "temperature_2m", "wind_speed_10m"],), ([],), (None,)],
                               "m array<string>")
    got = [(r.k, r.l) for r in df.select(keep_known(F.col("m")).alias("k"),
                                         last_element(F.col("m")).alias("l")).collect()]
    assert got == [(["temperature_2m", "wind_speed_10m"], "wind_speed_10m"), ([], None), (None, None)]
    assert rows(df.select(F.size(keep_known(F.col("m"))).alias("n")))[-1] == (2,)
