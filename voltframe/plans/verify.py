"""Side-by-side check of catalogue queries against their DuckDB oracle.

Used by the tests and by ``python -m voltframe.plans.verify [sf_dir] [query ...]
[--json report.json]``; it mirrors the driver's gate (row count, column names,
order-insensitive values).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _canon(v.item())
    except ImportError:  # pragma: no cover
        pass
    try:
        import pandas as pd
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime().isoformat()
        if v is pd.NaT:
            return "∅"
    except ImportError:  # pragma: no cover
        pass
    return str(v)


def canon_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def duck_connect(sf_dir: str):
    import duckdb

    from voltframe.sources.fixtures import DRIVER_TABLES
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict:
    from voltframe.plans.catalog import ORACLE, QUERIES
    con = duck_connect(sf_dir)
    report = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            t1 = time.time()
            if name not in ORACLE:
                report[name] = {"rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
                if verbose:
                    print(f"{name:28s} rows={len(srows):7d}  (no oracle)")
                continue
            cur = con.execute(ORACLE[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            a, ac = canon_rows(scols, srows)
            b, bc = canon_rows(dcols, drows)
            ok = (a == b) and (ac == bc)
            info = {"rows": len(srows), "oracle_rows": len(drows), "match": ok,
                    "cols_match": ac == bc, "spark_s": round(t1 - t0, 2)}
            if not ok:
                info["spark_cols"], info["oracle_cols"] = ac, bc
                sa, sb = set(a), set(b)
                diff_a = [r for r in a if r not in sb][:3]
                diff_b = [r for r in b if r not in sa][:3]
                info["only_spark"], info["only_oracle"] = diff_a, diff_b
            report[name] = info
            if verbose:
                print(f"{name:28s} rows={len(srows):7d} oracle={len(drows):7d} "
                      f"{'OK' if ok else 'MISMATCH'} {info['spark_s']}s")
                if not ok:
                    print("   cols", ac, bc)
                    print("   only spark ", info["only_spark"])
                    print("   only oracle", info["only_oracle"])
        except Exception as e:  # report and continue
            report[name] = {"error": f"{type(e).__name__}: {e}"[:2000]}
            if verbose:
                print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:1500]}")
    return report


if __name__ == "__main__":
    import json

    from voltframe.session import get_session
    args = sys.argv[1:]
    out_json = None
    if "--json" in args:
        i = args.index("--json")
        out_json = args[i + 1]
        del args[i:i + 2]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    spark = get_session("local[8]", 8)
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if not v.get("match", v.get("oracle", 1) is None)]
    print("FAILED:", bad)
    if out_json:
        with open(out_json, "w") as f:
            json.dump({"sf_dir": sf, "failed": bad, "queries": rep}, f, indent=1, default=str)
