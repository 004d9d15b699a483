"""Compare a registered Spark query with its DuckDB oracle SQL.

Used by the test-suite and runnable by hand:

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if exact:
            return repr(v)
        return f"{v:.9g}"
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    return str(v)


def canonical(rows: list[tuple], cols: list[str], exact: bool) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], exact) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = [tuple(r) for r in d.fetchall()]
    res["oracle_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    res["exact_match"] = canonical(s_rows, s_cols, True) == canonical(d_rows, d_cols, True)
    res["approx_match"] = canonical(s_rows, s_cols, False) == canonical(d_rows, d_cols, False)
    ok = res["cols_match"] and len(s_rows) == len(d_rows) and res["exact_match"]
    res["status"] = "ok" if ok else "MISMATCH"
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tessera.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, entry.queries()[n], entry.oracle_sql().get(n), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"query": n, "status": "ERROR", "error": str(e)[:500]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
