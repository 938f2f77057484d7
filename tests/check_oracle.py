"""Run registered queries against their SQL on the driver's tables: python tests/check_oracle.py [sf] [names...]"""

import datetime
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("set timezone='UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, db, sql):
    """None when equal, else a short description of the first difference."""
    got_columns = df.columns
    got = df.collect()
    result = db.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    names = sorted(got_columns)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        cells = [(n, p, q) for n, p, q in zip(names, x, y) if p != q]
        return f"{len(bad)} of {len(a)} rows differ, first: {cells} in {x}"
    return None


def main():
    import __spark_entry__ as entry
    from vulnlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, db, oracles[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            state = "ERROR " + str(error)[:1500]
            if names:
                traceback.print_exc()
        if not state.startswith(("ok", "rows only")):
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s {state[:1800]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
