"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

from hirelake.plans import catalog, oracle


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def spark_rows(spark, folder, name):
    df = catalog.queries()[name](spark, folder)
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, name):
    cur = con.execute(oracle.oracle_sql()[name])
    return _rows([d[0] for d in cur.description], cur.fetchall())


def types(spark, folder, con, name):
    """Columns whose type differs in kind between the two engines."""
    kinds = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
        "TIMESTAMP": "timestamp_ntz", "DATE": "date",
    }
    left = dict(catalog.queries()[name](spark, folder).dtypes)
    con.execute(f"CREATE OR REPLACE TEMP VIEW __t AS {oracle.oracle_sql()[name]}")
    right = {r[0]: kinds.get(r[1], r[1]) for r in con.execute("DESCRIBE __t").fetchall()}
    return {c: (left.get(c), right.get(c)) for c in left.keys() | right.keys() if left.get(c) != right.get(c)}


if __name__ == "__main__":
    import sys
    import time

    from hirelake.session import local_session

    folder = sys.argv[1]
    names = [n for n in catalog.queries() if len(sys.argv) < 3 or any(n.startswith(a) for a in sys.argv[2:])]
    session, con = local_session(), connect(folder)
    known = oracle.oracle_sql()
    for name in names:
        try:
            t0 = time.time()
            cols, rows = spark_rows(session, folder, name)
            t1 = time.time()
            if name not in known:
                print(f"rows {name}: {len(rows)} ({t1 - t0:.1f}s), no SQL", flush=True)
                continue
            ocols, orows = oracle_rows(con, name)
            t2 = time.time()
            bad = types(session, folder, con, name)
            ok = cols == ocols and rows == orows and not bad
            print(f"{'OK  ' if ok else 'DIFF'} {name}: {len(rows)} / {len(orows)} rows ({t1 - t0:.1f}s / {t2 - t1:.1f}s) {bad or ''}", flush=True)
            if not ok:
                print("   ", cols, ocols)
                a, b = set(rows), set(orows)
                for r in sorted(a - b)[:2]:
                    print("    spark ", str(r)[:600])
                for r in sorted(b - a)[:2]:
                    print("    oracle", str(r)[:600])
        except Exception as e:  # show every failing query in one run
            print(f"FAIL {name}: {str(e)[:700]}", flush=True)
