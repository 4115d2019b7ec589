"""Compare a registered query with its SQL on the same Parquet files."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(x):
    if x is None or isinstance(x, (bool, str, int)):
        return x
    if isinstance(x, decimal.Decimal):
        return ("decimal", str(x))
    if isinstance(x, float):
        return float(f"{x:.12g}")
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    return x


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark_df, con, statement: str) -> str | None:
    """None when both hold the same columns and the same rows."""
    answer = con.execute(statement)
    names = [d[0] for d in answer.description]
    want_cols, want = normal(names, answer.fetchall())
    got_cols, got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_cols != got_cols:
        return f"columns differ: {got_cols} and {want_cols}"
    if want == got:
        return None
    got_set, want_set = set(got), set(want)
    extra = [r for r in got if r not in want_set][:3]
    lacking = [r for r in want if r not in got_set][:3]
    return f"{len(got)} rows and {len(want)} rows; only ours {extra}; only SQL {lacking}"
