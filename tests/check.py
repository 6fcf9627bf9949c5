"""Run registered queries beside their SQL checks: python tests/check.py [dir] [name-part ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexloom.plans import ORACLES, QUERIES  # noqa: E402
from lexloom.plans.registry import TABLES  # noqa: E402


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, sf_dir):
    """(ok, rows, message) of one query against its SQL check."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return True, len(got), "rows only"
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return False, len(got), f"columns {sorted(df.columns)} vs {sorted(cols)}"
    if got != want:
        a, b = set(got), set(want)
        return False, len(got), f"rows {len(got)} vs {len(want)}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}"
    return True, len(got), "match"


if __name__ == "__main__":
    from lexloom.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark, con = local_session(**{"spark.ui.showConsoleProgress": "false"}), duck(sf)
    bad = 0
    for q in QUERIES:
        if parts and not any(q.startswith(p) for p in parts):
            continue
        t = time.time()
        try:
            ok, n, msg = compare(spark, con, q, sf)
        except Exception as e:  # report and go on
            ok, n, msg = False, -1, "ERROR " + str(e)[:900]
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {q} rows={n} {time.time() - t:.1f}s {msg if not ok or msg != 'match' else ''}", flush=True)
    print("bad:", bad, "queries:", len(QUERIES), "oracles:", len(ORACLES))
