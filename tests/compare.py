"""Spark against DuckDB: columns, kinds and rows, in any order."""

import datetime
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def difference(df, con, sql):
    """What differs, or None."""
    rel = con.sql(sql)
    want_columns, want_kinds = rel.columns, [str(x) for x in rel.types]
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} and {sorted(want_columns)}"
    kinds = dict(df.dtypes)
    odd = {c: (kinds[c], k) for c, k in zip(want_columns, want_kinds, strict=True) if KINDS.get(k, k) != kinds[c]}
    if odd:
        return f"kinds {odd}"
    got, want = rows_of(df.columns, df.collect()), rows_of(want_columns, rel.fetchall())
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; only here {[x for x in got if x not in set(want)][:2]}, only there {[x for x in want if x not in set(got)][:2]}"
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            if x != y and not (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1.1e-6)):
                return f"{a} and {b}"
    return None
