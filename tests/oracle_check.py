"""Compare every registered query with its DuckDB oracle.

Row count, column names/types and an order-insensitive value hash, like the
driver's correctness gate. Usable from pytest and as a script::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v.hex()  # exact: no rounding hides a difference
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    return v


def _digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                  "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
                  "timestamp_ntz": "TIMESTAMP"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in (names or list(qs)):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        stypes = [_SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in df.schema.fields]
        dt = time.time() - t0
        res = {"rows": len(rows), "sec": round(dt, 2)}
        if name in sqls:
            cur = con.execute(sqls[name])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
            otypes = [str(d[1]) for d in cur.description]
            res.update({
                "oracle_rows": len(orows),
                "names_match": sorted(cols) == sorted(ocols),
                "types_match": dict(zip(cols, stypes)) == dict(zip(ocols, otypes)),
                "hash_match": _digest(cols, rows) == _digest(ocols, orows),
            })
            if not res["types_match"]:
                res["types"] = [dict(zip(cols, stypes)), dict(zip(ocols, otypes))]
            res["ok"] = (res["rows"] == res["oracle_rows"] and res["names_match"]
                         and res["hash_match"])
        out[name] = res
    return out


if __name__ == "__main__":
    from landfall.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    result = compare(spark, sf, sys.argv[2:] or None)
    for k, v in result.items():
        print(k, json.dumps(v))
    bad = [k for k, v in result.items() if v.get("ok") is False]
    print("FAILED:", bad if bad else "none")
