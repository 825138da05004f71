"""Compare registered Spark queries with their DuckDB oracle statements.

``python -m lexis.plans.verify --sf /root/testdata/sf0.01 [keys...]`` prints
one line per query: rows, schema and order-insensitive value agreement
(floats to 6 dp; ``LEXIS_EXACT=1`` compares exact binary values).
Queries without an oracle get a rows-only run.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

from lexis.plans.registry import ORACLE, QUERIES, load_all
from lexis.sources.tables import TABLES

_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if os.environ.get("LEXIS_EXACT"):  # compare the exact binary value
            return repr(v)
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records)


def check(spark, sf_dir: str, key: str, con) -> dict:
    t0 = time.time()
    df = QUERIES[key](spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    spark_schema = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                    for f in df.schema.fields}
    out = {"key": key, "rows": len(spark_rows), "sec": round(time.time() - t0, 2)}
    if key not in ORACLE:
        out["oracle"] = "none"
        return out
    rel = con.sql(ORACLE[key])
    duck_rows = rel.fetchall()
    duck_schema = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out["oracle_rows"] = len(duck_rows)
    out["schema_ok"] = spark_schema == duck_schema
    if not out["schema_ok"]:
        out["schema"] = (spark_schema, duck_schema)
    a = _rows(spark_rows, df.columns)
    b = _rows(duck_rows, rel.columns)
    out["values_ok"] = a == b
    if not out["values_ok"] and len(a) == len(b):
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["diff"] = diff
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args(argv)
    from lexis.session import build_session
    spark = build_session(master=os.environ.get("LEXIS_MASTER", "local[8]"))
    load_all()
    con = duck(args.sf)
    keys = args.keys or sorted(QUERIES)
    bad = 0
    for k in keys:
        try:
            r = check(spark, args.sf, k, con)
        except Exception as e:  # report and continue with the next query
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = "error" not in r and r.get("oracle") == "none" or (r.get("schema_ok") and r.get("values_ok")
                                                                and r.get("rows") == r.get("oracle_rows"))
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
