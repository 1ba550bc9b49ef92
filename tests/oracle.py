"""Run a query on Spark and its SQL on DuckDB and compare names, rows and values, whatever their order."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def difference(df, db, sql):
    """None when equal, else a description of what differs."""
    want = db.sql(sql)
    if sorted(df.columns) != sorted(want.columns):
        return f"columns {sorted(df.columns)} and {sorted(want.columns)}"
    types = dict(df.dtypes)
    sql_types = {c: str(t).lower() for c, t in zip(want.columns, want.types)}
    same = {"string": "varchar", "bigint": "bigint", "int": "integer", "double": "double", "boolean": "boolean"}
    odd = {c: (t, sql_types[c]) for c, t in types.items() if same.get(t) != sql_types[c]}
    got_rows = rows_of(df.columns, df.collect())
    collected = time.time()
    want_rows = rows_of(want.columns, want.fetchall())
    if time.time() - collected > 5:
        print(f"  the SQL took {time.time() - collected:.1f}s")
    if got_rows != want_rows:
        only = sorted(set(got_rows) - set(want_rows))[:3], sorted(set(want_rows) - set(got_rows))[:3]
        short = [[tuple(v[:60] for v in r) for r in side] for side in only]
        return f"rows {len(got_rows)} and {len(want_rows)}, only in one: {short}"
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from uttera.session import local_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = local_session(8)
    db = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            said = difference(run(spark, sf_dir), db, oracles[name]) if name in oracles else "no oracle"
        except Exception as failure:
            said = f"{type(failure).__name__}: {str(failure)[:1500]}"
        print(f"{time.time() - started:6.2f}s {name}: {said or 'ok'}", flush=True)
