"""Spark-vs-DuckDB comparison used by the tests and the dev loop."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

EXACT = os.environ.get("EXACT") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_oracle(con, sql: str) -> pd.DataFrame:
    return con.execute(sql).df()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def diff(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, limit: int = 5) -> list[str]:
    """Empty list when equal (columns by name, rows as multisets)."""
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        problems.append(f"columns differ: spark-only {sorted(set(spark_pdf.columns) - set(duck_pdf.columns))}"
                        f" duck-only {sorted(set(duck_pdf.columns) - set(spark_pdf.columns))}")
        return problems
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}")
    a, b = canon(spark_pdf), canon(duck_pdf)
    cols = sorted(spark_pdf.columns)
    n = 0
    for ra, rb in zip(a, b):
        if ra != rb:
            bad = [(c, x, y) for c, x, y in zip(cols, ra, rb) if x != y]
            problems.append(f"row mismatch: {bad[:6]}")
            n += 1
            if n >= limit:
                break
    return problems
