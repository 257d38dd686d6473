"""Compare a query with its oracle SQL in DuckDB."""

import glob
import math
import os

import duckdb


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def oracle(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    kinds = {d[0]: str(d[1]) for d in got.description}
    return columns, kinds, got.fetchall()


SPARK_KIND = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def difference(df, sf_dir, sql):
    """None when equal, else a short text."""
    columns, kinds, want = oracle(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = dict(df.dtypes)
    bad = {c: (types[c], kinds[c]) for c in columns if SPARK_KIND.get(kinds[c], kinds[c]) != types[c]}
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(columns, want)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if got != want:
        first = next((g, w) for g, w in zip(got, want) if g != w)
        return f"rows differ: {first}"
    return f"types {bad}" if bad else None
