"""Local twin of the driver's correctness gate: run each registered Spark query
and its DuckDB oracle on the same parquet tables and compare
(row count, column names, order-insensitive values).

usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402,F401
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_val(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s.replace("T", " ")
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(_norm_val(x) for x in list(v))
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm_val(v.item())
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_val(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    dp = con.execute(sql).df()
    scols, srows = rows_of(sp)
    dcols, drows = rows_of(dp)
    dtypes = {c: (str(sp[c].dtype), str(dp[c].dtype)) for c in scols if c in dp.columns}
    bad_types = {c: v for c, v in dtypes.items()
                 if v[0] != v[1] and not ({v[0], v[1]} <= {"object", "datetime64[us]", "datetime64[ns]"})}
    if scols != dcols:
        return False, f"cols spark={scols} oracle={dcols}", t1 - t0
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} oracle={len(drows)}", t1 - t0
    diff = [(a, b) for a, b in zip(srows, drows) if a != b]
    if diff:
        return False, f"{len(diff)} rows differ e.g. spark={diff[0][0]} oracle={diff[0][1]}", t1 - t0
    if bad_types:
        return True, f"OK rows={len(srows)} (dtype note {bad_types})", t1 - t0
    return True, f"OK rows={len(srows)}", t1 - t0


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    from strata.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        if name not in orc:
            t0 = time.time()
            try:
                n = fn(spark, sf_dir).count()
                print(f"ROWS  {name}: {n} rows ({time.time()-t0:.1f}s)")
            except Exception as e:  # noqa: BLE001
                fails += 1
                print(f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            ok, msg, dt = compare(spark, con, name, fn, orc[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, dt = False, f"{type(e).__name__}: {str(e)[:600]}", 0
        fails += (not ok)
        print(f"{'PASS' if ok else 'FAIL'}  {name}: {msg} ({dt:.1f}s)")
    print(f"failures: {fails}")
    spark.stop()
    return fails


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
