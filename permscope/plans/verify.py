"""Local twin of the driver's correctness gate.

Runs each catalogued query on Spark and its oracle SQL on DuckDB over the
same parquet tables, then compares row count, column names and an
order-insensitive hash of the values.

    python -m permscope.plans.verify /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

from permscope.sources.tables import TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def compare(spark, sf_dir: str, names=None, con=None, verbose: bool = True) -> dict:
    from permscope.plans.catalog import queries, oracle_sql

    qs, os_ = queries(), oracle_sql()
    con = con or duck_connect(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {"oracle": name in os_}
        try:
            t = time.time()
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = list(sdf.columns)
            rec["spark_sec"] = round(time.time() - t, 3)
            rec["rows"] = len(srows)
            if name in os_:
                t = time.time()
                res = con.execute(os_[name])
                dcols = [d[0] for d in res.description]
                drows = res.fetchall()
                rec["duck_sec"] = round(time.time() - t, 3)
                rec["oracle_rows"] = len(drows)
                rec["schema_match"] = sorted(scols) == sorted(dcols)
                rec["value_match"] = rec["schema_match"] and _digest(srows, scols) == _digest(drows, dcols)
                rec["ok"] = rec["value_match"] and len(srows) == len(drows)
                if not rec["schema_match"]:
                    rec["cols"] = (scols, dcols)
            else:
                rec["ok"] = True
        except Exception as e:  # report and go on with the next query
            rec["ok"] = False
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from permscope import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v["ok"]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
