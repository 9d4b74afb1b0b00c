"""Run a query and its oracle side by side."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    table = df.select(*cols).toArrow()
    types = {f.name: str(f.type) for f in table.schema}
    data = [table[c].to_pylist() for c in cols]
    return cols, types, sorted((tuple(map(_plain, r)) for r in zip(*data)), key=repr)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    types = {c[0]: str(c[1]) for c in rel.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], types, sorted(rows, key=repr)
