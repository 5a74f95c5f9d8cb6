"""Run registered queries in Spark and their SQL statements in DuckDB and
compare row count, column names and an order-insensitive value hash.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], lines, h


def compare(spark, con, name, qfn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    sc, sl, sh = digest(scols, srows)
    dc, dl, dh = digest(dcols, drows)
    ok = sc == dc and len(srows) == len(drows) and sh == dh
    res["status"] = "MATCH" if ok else "MISMATCH"
    if not ok and verbose:
        if sc != dc:
            res["cols"] = (sc, dc)
        ss, ds = set(sl), set(dl)
        res["only_spark"] = sorted(ss - ds)[:3]
        res["only_oracle"] = sorted(ds - ss)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from twintally.session import build_session
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        try:
            r = compare(spark, con, n, qs[n], os_.get(n), sf_dir)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
