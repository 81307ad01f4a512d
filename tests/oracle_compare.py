"""Compare a Spark report with its DuckDB oracle: row count, column names, values.

Run as a script to check every registered report:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerlens.sources.tables import TABLES  # noqa: E402


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _spark_type(t: str) -> str:
    return {"int": "int32", "integer": "int32", "bigint": "int64", "double": "float64", "string": "text",
            "timestamp_ntz": "timestamp", "date": "date", "boolean": "bool"}.get(t, t)


def _duck_type(t: str) -> str:
    t = t.upper()
    return {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "text", "STRING": "text",
            "TIMESTAMP": "timestamp", "DATE": "date", "BOOLEAN": "bool"}.get(t, t.lower())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):   # numpy scalar
        return _norm(v.item())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_data = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_data = res.fetchall()
    msgs = []
    s_types = {f.name.lower(): _spark_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {d[0].lower(): _duck_type(str(d[1])) for d in res.description}
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_types if d_types.get(c) not in (None, s_types[c])}
    if bad_types:
        msgs.append(f"types differ: {bad_types}")
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        msgs.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_data) != len(d_data):
        msgs.append(f"rows differ: spark={len(s_data)} duck={len(d_data)}")
    if not msgs:
        a, b = _rows(s_cols, s_data), _rows(d_cols, d_data)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            msgs.append(f"values differ, first: {diff}")
    ok = not msgs
    return ok, f"{name}: {'OK' if ok else 'FAIL'} rows={len(s_data)} spark={t1 - t0:.2f}s " + "; ".join(msgs)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from ledgerlens.session import local_session
    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in orc:
            print(f"{name}: no oracle")
            continue
        try:
            ok, msg = compare(spark, name, fn, orc[name], sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(msg, flush=True)
    print(f"failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
