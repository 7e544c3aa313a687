"""Run every registered query on Spark and its oracle SQL on DuckDB and
compare row count, column names and an order-insensitive value multiset.

usage: python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quire.session import build_session  # noqa: E402
from quire.sources.tables import RAW_TABLES, table_path  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return ("f", repr(v))          # exact: both sides convert the same decimal
    if isinstance(v, Decimal):
        return ("d", str(v))
    if isinstance(v, (bytes, bytearray)):
        return ("b", bytes(v).hex())
    if isinstance(v, list):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((k, norm(x)) for k, x in v.items())))
    return (type(v).__name__, v if v is None or isinstance(v, (int, str, bool)) else str(v))


def pandas_rows(pdf):
    """Rows of a pandas frame with columns sorted by name; NaN/NA/NaT → None,
    numpy scalars → Python values (the kind of normalisation a hash over
    client-side frames needs)."""
    import pandas as pd
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for row in pdf.itertuples(index=False):
        vals = []
        for v in row:
            if v is None or (not isinstance(v, (list, dict, bytes)) and pd.isna(v)):
                vals.append(None)
            elif hasattr(v, "item"):
                vals.append(v.item())
            elif isinstance(v, pd.Timestamp):
                vals.append(str(v))
            else:
                vals.append(v)
        out.append(tuple(str(x) if x is not None else None for x in vals))
    return Counter(out)


def compare_pandas(spark, con, q, sf_dir):
    s = pandas_rows(q.build(spark, sf_dir).toPandas())
    d = pandas_rows(con.execute(q.sql).df())
    if s == d:
        return "ok", ""
    return "FAIL", f"spark-only {list((s - d).elements())[:2]} duck-only {list((d - s).elements())[:2]}"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in RAW_TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, q, sf_dir, verbose=True):
    t0 = time.time()
    df = q.build(spark, sf_dir)
    s_cols = df.columns
    s_rows = df.collect()
    t_spark = time.time() - t0
    if q.sql is None:
        return ("rows-only", len(s_rows), t_spark, "")
    cur = con.execute(q.sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    msg = []
    if sorted(s_cols) != sorted(d_cols):
        msg.append(f"cols spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return ("FAIL", len(s_rows), t_spark, "; ".join(msg))
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        msg.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        msg.append(f"values differ; cols={order}\n   spark-only {only_s}\n   duck-only  {only_d}")
    return ("ok" if not msg else "FAIL", len(s_rows), t_spark, "; ".join(msg))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]  # may include --pandas
    spark = build_session("local[8]", "oracle-check", shuffle_partitions=8)
    from quire.plans import load_all
    reg = load_all()
    con = duck(sf_dir)
    bad = 0
    pandas_mode = "--pandas" in keys
    keys = [k for k in keys if k != "--pandas"]
    for name, q in reg.items():
        if keys and name not in keys:
            continue
        try:
            if pandas_mode:
                if q.sql is None:
                    continue
                status, msg = compare_pandas(spark, con, q, sf_dir)
                n, t = 0, 0.0
            else:
                status, n, t, msg = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            status, n, t, msg = "ERROR", -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += status in ("FAIL", "ERROR")
        print(f"{status:9s} {name:28s} rows={n:<8d} {t:6.2f}s {msg}", flush=True)
    print(f"{len(reg)} registered, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
