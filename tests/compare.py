"""Run a registered query on Spark and its oracle SQL on DuckDB; compare.

Used by the test suite and runnable by hand:

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float) or type(v).__name__.startswith("float"):
        v = float(v)
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 6))
    if type(v).__name__.startswith(("int", "uint")):
        return str(int(v))
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v)) if not isinstance(v, str) else v
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return str(v)


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple("" if x is None else x for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_pdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_pdf), "spark_sec": round(t1 - t0, 2)}
    sql = entry.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    d_pdf = con.execute(sql).df()
    res["duck_rows"] = len(d_pdf)
    res["cols_match"] = sorted(s_pdf.columns) == sorted(d_pdf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(s_pdf.columns)
        res["duck_cols"] = sorted(d_pdf.columns)
        res["match"] = False
        return res
    a, b = canon(s_pdf), canon(d_pdf)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["only_spark"] = diff_a
        res["only_duck"] = diff_b
    return res


if __name__ == "__main__":
    from strata.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    con = duck(sf)
    bad = 0
    for n in names or list(entry.queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": repr(e)[:500]}
        ok = r.get("match") or r.get("oracle") == "none"
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print("failures:", bad)
