"""Run each registered query in Spark and its oracle SQL in DuckDB; compare rows.

Usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from riskloom.plans.registry import all_oracles, all_queries  # noqa: E402
from riskloom.session import local_session  # noqa: E402
from riskloom.sources.tables import TABLES  # noqa: E402


STRICT = os.environ.get("COMPARE_STRICT") == "1"  # exact floats, as a byte-level value hash would see them


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in row)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
            "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(sdf, rel):
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for c, t in sdf.dtypes:
        want = TYPE_MAP.get(t, t.upper())
        if duck_types.get(c) != want:
            out.append((c, t, duck_types.get(c)))
    return out


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(norm(v) for v in r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return f"{name:34s} spark {ts:6.2f}s rows={len(srows)} (no oracle)", True
    rel = con.sql(sql)
    dcols = rel.columns
    drows = [tuple(norm(v) for v in r) for r in rel.fetchall()]
    if sorted(cols) != sorted(dcols):
        return f"{name:34s} COLUMNS differ spark={cols} duck={dcols}", False
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in drows]
    ok = sorted(srows, key=key) == sorted(drows, key=key)
    msg = f"{name:34s} spark {ts:6.2f}s rows={len(srows)} duck rows={len(drows)} {'OK' if ok else 'MISMATCH'}"
    td = type_diffs(sdf, rel)
    if td:
        ok = False
        msg += f" TYPES {td}"
    if not ok:
        a, b = sorted(srows, key=key), sorted(drows, key=key)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        msg += f"\n    first diffs: {diff}"
    return msg, ok


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    qs, orc = all_queries(), all_oracles()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            msg, ok = compare(spark, con, sf_dir, name, fn, orc.get(name))
        except Exception as e:  # report and continue
            msg, ok = f"{name:34s} ERROR {type(e).__name__}: {str(e)[:400]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"{len(qs) - bad}/{len(qs)} ok" if not names else f"bad={bad}")


if __name__ == "__main__":
    main()
