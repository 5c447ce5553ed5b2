"""Rows of a query and of its SQL, in one form for comparison."""

import datetime
import decimal
import math
import os

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float | decimal.Decimal):
        return "nan" if math.isnan(v) else repr(round(float(v), 6))
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat() if isinstance(v, datetime.date | datetime.datetime) else str(v)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    r = con.sql(sql)
    columns = sorted(r.columns)
    order = [r.columns.index(c) for c in columns]
    return columns, sorted(tuple(plain(row[k]) for k in order) for row in r.fetchall())
