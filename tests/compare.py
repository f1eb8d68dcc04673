"""Run a query beside its SQL and report the first difference."""

import datetime
import glob
import math
import os

import duckdb


def connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted([tuple(_value(r[n]) for n in order) for r in data], key=repr)


def difference(df, con, sql) -> str | None:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = _rows(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _rows(df.columns, df.collect())
    if got == want:
        return None
    odd_got = [r for r in got if r not in set(want)][:2]
    odd_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows != {len(want)} rows\n got {odd_got}\nwant {odd_want}"
