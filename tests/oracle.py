"""Compare a Spark result with the same query in DuckDB, value by value."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(dtype) -> str:
    text = str(dtype)
    return "text" if text in ("object", "str", "string") or text.startswith("str") else text


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)].astype(object).where(lambda d: d.notna(), None)
    rows = [tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in r)
            for r in pdf.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) if v is None else (False, "", str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    problems = []
    for c in sorted(got.columns):
        a, b = _kind(got[c].dtype), _kind(want[c].dtype)
        nulls = got[c].isna().any() or want[c].isna().any()
        if a != b and not (nulls and {a, b} <= {"int64", "float64", "Int64", "text"}):
            problems.append(f"type of {c}: {a} != {b}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    a, b = _rows(got), _rows(want)
    bad = [(x, y) for x, y in zip(a, b) if not _same(x, y)]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems


def _same(x: tuple, y: tuple) -> bool:
    return all(p == q or (p is not None and q is not None and not isinstance(p, str) and float(p) == float(q))
               for p, q in zip(x, y))
