"""Side-by-side check of the registered Spark queries against their DuckDB SQL.

Compares row count, column names and types, and an order-insensitive multiset
of rows (columns sorted by name, values compared exactly), the way the driver's
correctness gate does.

    python tests/oracle_check.py [sf_dir] [query ...]
"""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


# Spark type -> DuckDB type of the same values.
CANON = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
         "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    out = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(time.time() - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        out["status"] = "SCHEMA"
        out["detail"] = {"spark_only": sorted(set(s_names) - set(d_names)),
                         "oracle_only": sorted(set(d_names) - set(s_names))}
        return out
    s_types = {f.name: CANON.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(con.sql(sql).columns, con.sql(sql).types)}
    if s_types != d_types:
        out["status"] = "TYPES"
        out["detail"] = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
        return out
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a == b:
        out["status"] = "OK"
    else:
        out["status"] = "VALUES"
        cols = sorted(s_names)
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["detail"] = {"columns": cols, "spark_only": only_s, "oracle_only": only_d,
                         "n_spark_only": sum((a - b).values()), "n_oracle_only": sum((b - a).values())}
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from trafficwatch.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, sf_dir, name, q, sqls.get(name), con)
        except Exception as exc:  # report and go on
            r = {"query": name, "status": "ERROR", "detail": repr(exc)[:800]}
        bad += r["status"] not in ("OK", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
