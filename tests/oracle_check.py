"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return ("temporal-not-presented", str(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, q, sql):
    t0 = time.time()
    df = q(spark, sf_dir)
    srows = df.collect()
    t1 = time.time()
    scols = df.columns
    if sql is None:
        return "rows-only", len(srows), t1 - t0, ""
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    if sc != dc:
        return "COLS", len(srows), t1 - t0, f"spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return "COUNT", len(srows), t1 - t0, f"spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return "VALUES", len(srows), t1 - t0, f"{len(bad)} diff e.g. {bad[0]}"
    return "ok", len(srows), t1 - t0, ""


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from quarry.session import build_session
    import __spark_entry__ as e
    spark = build_session("local[8]", shuffle_partitions=8)
    if os.environ.get("QUARRY_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["QUARRY_TZ"])
    con = duck(sf_dir)
    qs, orc = e.queries(), e.oracle_sql()
    names = [n for n in qs if not pats or any(p in n for p in pats)]
    failures = 0
    for n in names:
        try:
            status, nrows, secs, info = compare(spark, con, sf_dir, n, qs[n], orc.get(n))
        except Exception as ex:  # noqa: BLE001
            status, nrows, secs, info = "ERROR", -1, 0.0, repr(ex)[:400]
        if status not in ("ok", "rows-only"):
            failures += 1
        print(f"{status:9s} {n:34s} rows={nrows:<7d} {secs:6.2f}s {info}", flush=True)
    print(f"failures={failures} of {len(names)}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
