"""Run the registered queries next to their SQL twins and report differences.

    python -m checks.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from decimal import Decimal

import duckdb
import pandas as pd

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in ALL_TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return repr(v) if isinstance(v, float) else str(v)


def rows(names, data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, text):
    cur = con.execute(text)
    return rows([d[0] for d in cur.description], cur.fetchall())


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def compare(spark, con, name, fn, text, sf_dir) -> str:
    start = time.time()
    df = fn(spark, sf_dir)
    got = spark_rows(df)
    took = time.time() - start
    if text is None:
        return f"rows {len(got):>7}  {took:5.1f}s  {name}"
    kinds = {r[0]: r[1] for r in con.execute(f"describe {text}").fetchall()}
    mine = dict(df.dtypes)
    if set(kinds) != set(mine):
        return f"COLUMNS        {name}: only spark {set(mine)-set(kinds)}, only sql {set(kinds)-set(mine)}"
    want = duck_rows(con, text)
    odd = {c: (mine[c], kinds[c]) for c in mine
           if KINDS.get(mine[c], mine[c].upper()) != kinds[c] and not mine[c].startswith("decimal")}
    odd |= {c: (mine[c], kinds[c]) for c in mine
            if mine[c].startswith("decimal") and mine[c].upper() != kinds[c]}
    note = f"  types {odd}" if odd else ""
    if got == want:
        return f"ok   {len(got):>7}  {took:5.1f}s  {name}{note}"
    a, b = set(got), set(want)
    cols = sorted(mine)
    return (f"DIFF {len(got)} vs {len(want)}  {name}{note}\n   columns {cols}\n   only spark {sorted(a-b)[:2]}\n   only sql   {sorted(b-a)[:2]}")


def main(argv=None) -> int:
    args = argparse.ArgumentParser()
    args.add_argument("names", nargs="*")
    args.add_argument("--sf", default="0.01")
    opts = args.parse_args(argv)
    from costloom.session import build_session

    from . import queries as q

    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{opts.sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in q.QUERIES.items():
        if opts.names and name not in opts.names:
            continue
        try:
            line = compare(spark, con, name, fn, q.ORACLES.get(name), sf_dir)
        except Exception as e:  # report and go on
            line = f"ERROR          {name}: {str(e)[:600]}"
            if opts.names:
                traceback.print_exc()
        bad += not line.startswith(("ok", "rows"))
        print(line, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
