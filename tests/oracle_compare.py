"""Spark-vs-DuckDB comparison in the driver's manner: row count, column names,
and an order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

DRIVER_VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark_df, con, sql: str) -> dict:
    s_cols, s_rows = canonical(*spark_rows(spark_df))
    d_cols, d_rows = canonical(*duck_rows(con, sql))
    result = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": s_cols == d_cols,
        "values_match": s_rows == d_rows,
    }
    if not result["columns_match"]:
        result["columns"] = (s_cols, d_cols)
    elif not result["values_match"]:
        s_set, d_set = set(s_rows), set(d_rows)
        result["only_spark"] = sorted(s_set - d_set, key=_key)[:5]
        result["only_oracle"] = sorted(d_set - s_set, key=_key)[:5]
    result["ok"] = result["columns_match"] and result["values_match"]
    return result
