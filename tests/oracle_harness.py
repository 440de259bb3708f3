"""Run registered Spark queries and their DuckDB oracle side by side and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    cols = df.columns
    srows = df.collect()
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    out["oracle_rows"] = len(drows)
    if sorted(cols) != sorted(dcols):
        out["status"] = f"COLUMNS spark={sorted(cols)} oracle={sorted(dcols)}"
        return out
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=_key)
    d = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=_key)
    if s == d:
        out["status"] = "ok"
    else:
        sset, dset = set(s), set(d)
        out["status"] = "MISMATCH"
        out["only_spark"] = [dict(zip(order, r)) for r in list(sset - dset)[:3]]
        out["only_oracle"] = [dict(zip(order, r)) for r in list(dset - sset)[:3]]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from soukline.session import build_session
    from __spark_entry__ import queries
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
