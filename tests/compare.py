"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return value


def _ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def from_spark(df):
    return _ordered(df.columns, [tuple(r) for r in df.collect()])


def from_sql(con, sql):
    done = con.execute(sql)
    return _ordered([c[0] for c in done.description], done.fetchall())


def differences(spark, con, sf_dir, query, sql) -> list[str]:
    names, rows = from_spark(query(spark, sf_dir))
    sql_names, sql_rows = from_sql(con, sql)
    if names != sql_names:
        return [f"columns {names} != {sql_names}"]
    if len(rows) != len(sql_rows):
        return [f"{len(rows)} rows != {len(sql_rows)}"]
    return [f"{a} != {b}" for a, b in zip(rows, sql_rows) if a != b][:5]
