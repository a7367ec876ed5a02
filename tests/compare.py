"""Rows of a query and of its SQL, made comparable."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{src}')")
    return con


def cell(x):
    return round(x, 6) if isinstance(x, float) else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([cell(r[i]) for i in order] for r in rows), key=repr)


def differences(df, con, sql):
    """None if rows, names and kinds of columns are alike; else what isn't."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} and {sorted(want_names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    have, need = {n: kinds.get(t, t) for n, t in df.dtypes}, {d[0]: str(d[1]) for d in cur.description}
    kind = {n: (have[n], need[n]) for n in have if have[n] != need[n] and need[n] != '"NULL"'}
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    if a != b:
        only_a, only_b = [x for x in a if x not in b][:2] if len(a) < 20000 else a[:1], [x for x in b if x not in a][:2] if len(b) < 20000 else b[:1]
        return f"{len(a)} and {len(b)} rows; only here {str(only_a)[:600]}; only in SQL {str(only_b)[:600]}"
    return f"kinds {kind}" if kind else None
