"""Rows of a Spark query against rows of its SQL in DuckDB."""

import datetime
import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return float(v) if type(v).__name__ == "Decimal" else v


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)


def sql_rows(folder, sql):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
