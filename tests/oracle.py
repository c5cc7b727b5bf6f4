"""Runs a registered query and its SQL on the same tables and compares the results."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, rows


def sql_rows(con, sql):
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    order = sorted(range(len(found)), key=found.__getitem__)
    return [found[i] for i in order], [tuple(_plain(row[i]) for i in order) for row in cur.fetchall()]


def compare(df, con, sql):
    """None when equal, else a short account of the difference."""
    left_names, left = spark_rows(df)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    a, b = Counter(left), Counter(right)
    if a != b:
        return f"{len(left)} rows / {len(right)} rows; only left {list((a - b))[:2]}; only right {list((b - a))[:2]}"
    types = [{type(v).__name__ for v in col if v is not None} for col in zip(*left)]
    other = [{type(v).__name__ for v in col if v is not None} for col in zip(*right)]
    if types != other:
        return f"types {list(zip(left_names, types, other))}"
    return None
