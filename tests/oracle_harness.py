"""Run registered queries against their DuckDB oracle (row count, columns,
order-insensitive value hash), the same comparison the round driver makes.

    python tests/oracle_harness.py [/root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def value_hash(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


def duck(data_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{data_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, data_dir):
    t0 = time.time()
    df = fn(spark, data_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "rows": len(rows), "spark_s": round(t_spark, 2)}
    if sql is None:
        out["match"] = None
        return out
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    out.update(
        oracle_rows=len(orows),
        cols_match=sorted(cols) == sorted(ocols),
        match=(len(rows) == len(orows) and sorted(cols) == sorted(ocols)
               and value_hash(cols, rows) == value_hash(ocols, orows)),
    )
    if not out["cols_match"]:
        out["cols"] = [cols, ocols]
    return out


def main(argv):
    data_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from scriptorium.session import local_session
    import __spark_entry__ as E
    spark = local_session()
    con = duck(data_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), data_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(json.dumps(r), flush=True)
    print(json.dumps({"failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
