"""Run each catalogue query in Spark and its SQL twin in DuckDB; compare.

Row count, column names, and an order-insensitive value comparison (columns
sorted by name, rows sorted).  Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["match"] = None
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    res["schema_match"] = sc == dc
    res["match"] = sc == dc and sr == dr
    if not res["match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        only_s = sorted(set(sr) - set(dr))[:3]
        only_d = sorted(set(dr) - set(sr))[:3]
        res["only_spark"], res["only_oracle"] = only_s, only_d
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from stratus.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as exc:  # report and go on
            r = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
