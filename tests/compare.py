"""Rows of Spark and of DuckDB in one form."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def rows_of(rows):
    return sorted(tuple(plain(x) for x in r) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def same_rows(df, con, sql):
    columns = sorted(df.columns)
    names = sorted(con.sql(sql).columns)
    assert names == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert rows_of(df.select(*columns).collect()) == rows_of(con.sql(f"SELECT {quoted} FROM ({sql.strip().rstrip(';')})").fetchall())
