"""Row comparison between a Spark result and a DuckDB result."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted(rows) -> list[tuple]:
    cells = [tuple(_cell(v) for v in row) for row in rows]
    return sorted(cells, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, _sorted(df.select(*(f"`{n}`" for n in names)).collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return [names[i] for i in order], _sorted(rows)
