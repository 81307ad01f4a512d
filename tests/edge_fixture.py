"""A small source folder with the edge cases the generated tables lack.

Same table names and column types as the driver's test data, so every report
and oracle runs on it unchanged. Contents (FIXTURES.md part 4):
duplicate fact rows, a fact row whose scenario is missing, NULL keys in the
order lines (NOT IN returns nothing), orders without a customer, NULL weights, NULL brands (names
without '-'), upper/lower-case text, half prices for the integer cast, a
missing month, non-midnight order times (the 'mm' minutes pattern), NULL
statuses, flags, priorities and prices.
"""

from __future__ import annotations

import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq

SCHEMAS = {
    "region": [("r_regionkey", pa.int32()), ("r_name", pa.string())],
    "nation": [("n_nationkey", pa.int32()), ("n_name", pa.string()), ("n_regionkey", pa.int32())],
    "customer": [("c_custkey", pa.int64()), ("c_name", pa.string()), ("c_nationkey", pa.int32()),
                 ("c_acctbal", pa.float64()), ("c_mktsegment", pa.string())],
    "part": [("p_partkey", pa.int64()), ("p_name", pa.string()), ("p_brand", pa.string()), ("p_type", pa.string()),
             ("p_size", pa.int32()), ("p_retailprice", pa.float64())],
    "orders": [("o_orderkey", pa.int64()), ("o_custkey", pa.int64()), ("o_orderstatus", pa.string()),
               ("o_totalprice", pa.float64()), ("o_orderdate", pa.timestamp("us")), ("o_orderpriority", pa.string())],
    "lineitem": [("l_orderkey", pa.int64()), ("l_partkey", pa.int64()), ("l_suppkey", pa.int64()),
                 ("l_linenumber", pa.int32()), ("l_quantity", pa.float64()), ("l_extendedprice", pa.float64()),
                 ("l_discount", pa.float64()), ("l_tax", pa.float64()), ("l_returnflag", pa.string()),
                 ("l_linestatus", pa.string()), ("l_shipdate", pa.timestamp("us"))],
}


def _write(folder: str, name: str, rows: list[tuple]) -> None:
    fields = SCHEMAS[name]
    cols = {f: [r[i] for r in rows] for i, (f, _) in enumerate(fields)}
    table = pa.table({f: pa.array(cols[f], type=t) for f, t in fields})
    pq.write_table(table, os.path.join(folder, f"{name}.parquet"))


def build(folder: str, seed: int = 11) -> str:
    os.makedirs(folder, exist_ok=True)
    rnd = random.Random(seed)
    _write(folder, "region", [(0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"), (4, "MIDDLE EAST")])
    _write(folder, "nation", [(k, f"NATION_{k}", k % 5) for k in range(8)])
    segs = ["BUILDING", "building ", "MACHINERY", None, "HOUSEHOLD"]   # case and a trailing blank
    _write(folder, "customer", [(k, f"Customer#{k:04d}", k % 8 if k != 3 else None, 10.0 * k, segs[k % 5])
                                for k in range(1, 21)])

    colors = ["red", "blue", "hot", "cold", "small"]
    kinds = ["bolt", "ring", "widget", "gear"]
    types = ["STANDARD", "standard", "ECONOMY", "PROMO"]
    parts = []
    for k in range(1, 31):
        brand = None if k % 13 == 0 or k == 27 else f"Brand#{rnd.randint(1, 25)}"
        size = None if k % 11 == 0 else rnd.choice([1, 2, 7, 7, 20])
        price = [950.5, 949.99, 951.0, 950.99][k % 4] if k % 3 == 0 else 900 + k
        color = colors[k % 5].upper() if k % 12 == 4 else colors[k % 5]         # e.g. part 16: BLUE bolt
        parts.append((k, f"{color} {kinds[k % 4]}", brand, types[k % 4], size, price))
    _write(folder, "part", parts)

    orders, lines = [], []
    okey = 0
    for year in (1997, 1998):
        for month in range(1, 13):
            if (year, month) == (1998, 3):          # a missing month
                continue
            for _ in range(3):
                okey += 1
                day = rnd.randint(1, 28)
                ts = dt.datetime(year, month, day, 0, rnd.choice([0, 0, 15, 45]))
                status = rnd.choice(["F", "F", "O", "P", None])
                prio = rnd.choice(["1-URGENT", "2-HIGH", "2-HIGH", "5-LOW", None])
                cust = None if rnd.random() < 0.08 else rnd.randint(1, 20)    # some orders without a customer
                orders.append((okey, cust, status, 1000.0 * okey, ts, prio))
                for ln in range(1, rnd.randint(2, 5)):
                    pk = rnd.randint(1, 30)
                    if rnd.random() < 0.05:
                        pk = 99                         # no such scenario
                    flag = rnd.choice(["R", "A", "N", None])
                    price = None if rnd.random() < 0.03 else round(rnd.uniform(1000, 90000), 2)
                    ship = ts + dt.timedelta(days=rnd.randint(1, 30))
                    row = (okey, pk, 1, ln, 1.0, price, 0.0, 0.0, flag, "F", ship)
                    lines.append(row)
                    if rnd.random() < 0.08:
                        lines.append(row)               # an exact duplicate line
    # order lines before the detail cut-off, one with a NULL part key
    orders.append((okey + 1, 5, "F", 1.0, dt.datetime(1995, 2, 1), "1-URGENT"))
    lines.append((okey + 1, 4, 1, 1, 1.0, 500.0, 0.0, 0.0, "R", "F", dt.datetime(1995, 2, 2)))
    lines.append((okey + 1, None, 1, 2, 1.0, 500.0, 0.0, 0.0, "R", "F", dt.datetime(1995, 2, 3)))
    _write(folder, "orders", orders)
    _write(folder, "lineitem", lines)
    return folder
