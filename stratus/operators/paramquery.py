"""Parametric query: one request."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.batched import normalize_requests

GROUP_KEYS = ("city_id", "city_name", "country", "date")


class RequestError(ValueError):
    """A request that cannot run; becomes an ``error`` status, not a result."""


@dataclass(frozen=True)
class QueryParams:
    request_id: str
    city_ids: tuple[str, ...]
    date_from: dt.date | None
    date_to: dt.date | None
    metrics: tuple[str, ...]
    agg: str

    @property
    def columns(self) -> list[str]:
        return [f"{self.agg}_{m}" for m in self.metrics]


def resolve(conf: Mapping[str, Any] | None = None, **kw: Any) -> QueryParams:
    """One request, resolved and checked by the rules for request
    tables (:func:`stratus.operators.batched.normalize_requests`), as a table of
    one row.  ``kw`` overrides ``conf`` where it is not null; lists may also come
    as comma-separated text."""
    given = dict(conf or {})
    given.update((k, v) for k, v in kw.items() if v is not None)

    def text(name: str):
        v = given.get(name)
        return None if v is None else str(v)

    def items(name: str):
        v = given.get(name)
        return [v] if isinstance(v, str) and v else [str(x) for x in v or []]

    spark = SparkSession.builder.getOrCreate()
    row = normalize_requests(spark.createDataFrame(
        [(text("request_id"), items("city_ids"), text("date_from"), text("date_to"), items("metrics"), text("agg"))],
        "request_id string, city_ids array<string>, date_from string, date_to string, "
        "metrics array<string>, agg string")).first()
    if row["error"]:
        raise RequestError(row["error"])
    return QueryParams(row["request_id"], tuple(row["city_ids"]), row["date_from"], row["date_to"],
                       tuple(row["metrics"]), row["agg"])


def selected(p: QueryParams) -> Column:
    """City list (empty = all) and inclusive days (open where not given),
    as literals on plain columns, so they reach the scan and prune ``date=``."""
    test = F.lit(True)
    if p.date_from or p.date_to:
        test = F.col("date").between(*(F.lit((given or end).isoformat()).cast("date") for given, end in
                                       ((p.date_from, dt.date.min), (p.date_to, dt.date.max))))
    return test & F.col("city_id").isin(*p.city_ids) if p.city_ids else test


def param_query(bronze: DataFrame, p: QueryParams, ordered: bool = True) -> DataFrame:
    """E2 + B5: ``<agg>_<metric>`` per requested metric by (city, date)."""
    values = [F.call_function(p.agg, F.col(m)).alias(name) for m, name in zip(p.metrics, p.columns)]
    out = bronze.where(selected(p)).groupBy(*GROUP_KEYS).agg(*values)
    return out.orderBy("city_id", "date") if ordered else out


def write_result(result: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite the request's folder with rows ordered by (city_id, date).

    The sort is applied after the repartition (sorting first and then
    repartitioning loses the order).  By default the output is range
    partitioned, so part files are in global order and no single task holds a
    large result; ``single_file`` gives one file as the original job did.
    """
    if single_file:
        df = result.repartition(1)
    else:
        df = result.repartitionByRange("city_id", "date")
    df.sortWithinPartitions("city_id", "date").write.mode("overwrite").parquet(path)
