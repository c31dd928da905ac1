"""Comparison of a registered query with its SQL counterpart, by sorted values."""

import math
from decimal import Decimal

import duckdb

from tallyloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return round(float(value), 6)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    return _sorted([d[0] for d in result.description], result.fetchall())
