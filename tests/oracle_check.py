"""Compare registered queries with their SQL on DuckDB: names, types, rows and values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def kind(v):
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def compare(spark_df, con, sql):
    """Return (ok, message)."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    cols = sorted(spark_df.columns)
    if cols != sorted(names):
        return False, f"columns {cols} vs {sorted(names)}"
    mine = [tuple(r[c] for c in cols) for r in spark_df.collect()]
    index = [names.index(c) for c in cols]
    theirs = [tuple(r[i] for i in index) for r in theirs]
    if len(mine) != len(theirs):
        return False, f"rows {len(mine)} vs {len(theirs)}"
    for i, c in enumerate(cols):
        a = {kind(r[i]) for r in mine if r[i] is not None}
        b = {kind(r[i]) for r in theirs if r[i] is not None}
        if a != b:
            return False, f"type of {c}: {a} vs {b}"
    a = sorted(repr([plain(v) for v in r]) for r in mine)
    b = sorted(repr([plain(v) for v in r]) for r in theirs)
    for x, y in zip(a, b):
        if x != y:
            diff = sum(1 for p, q in zip(a, b) if p != q)
            return False, f"{diff} rows differ:\n  spark {x[:600]}\n  duck  {y[:600]}"
    return True, f"{len(mine)} rows"


def main(argv):
    from sightline.plans import registry
    from sightline.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("ONLY"):
        registry.MODULES = tuple(os.environ["ONLY"].split(","))
    queries, oracles = registry.load_all()
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    wanted = [n for n in queries if not argv or any(n.startswith(a) for a in argv)]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                ok, message = compare(df, con, oracles[name])
            else:
                n = len(df.collect())
                ok, message = n > 0, f"{n} rows (no SQL)"
        except Exception as error:  # report and go on
            ok, message = False, f"{type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {message}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} passed")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
