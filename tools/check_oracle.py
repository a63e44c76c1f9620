"""Run every catalogue query and its DuckDB oracle side by side and compare
row count, column names and the order-insensitive multiset of values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def frame_rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s), "oracle": None, "ok": None, "sec": round(t1 - t0, 2)}
    d = con.execute(sql).df()
    sc, sr = frame_rows(s)
    dc, dr = frame_rows(d)
    ok = sc == dc and len(sr) == len(dr) and sr == dr
    info = {"name": name, "rows": len(s), "oracle_rows": len(d), "ok": ok, "sec": round(t1 - t0, 2)}
    if not ok:
        info["cols"] = (sc, dc)
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        info["diff"] = diff
    return info


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from sparkdeck.plans.catalog import REGISTRY
    from sparkdeck.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import os
    extra = {}
    spark = get_session("local[8]", shuffle_partitions=8, extra=extra)
    con = duck(sf)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sql, sf, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": repr(e)[:400]}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
