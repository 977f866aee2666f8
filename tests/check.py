"""Run registered queries against DuckDB: python tests/check.py [sf] [prefix ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, text):
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(text)
    want = rows_of(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra, missing = got[1] - want[1], want[1] - got[1]
        return (f"rows {sum(got[1].values())} vs {sum(want[1].values())}; {sum(extra.values())} differ\n   columns {got[0]}"
                f"\n   spark {list(extra)[:3]}\n   sql   {list(missing)[:3]}")
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from zoneflow.session import build_spark
    sf, prefixes = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_spark(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(fn(spark, sf_dir), con, oracles[name])
            else:
                problem = None if fn(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        tag = "FAIL" if problem else ("ok  " if name in oracles else "rows")
        print(f"{tag} {time.time() - t:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
