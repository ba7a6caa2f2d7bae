"""Compare a Spark result with the same query in DuckDB: names, row count and values."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def value(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
            return "null"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (float, np.floating)):
            return repr(float(v) + 0.0)
        if isinstance(v, (int, np.integer)):
            return str(int(v))
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return str(v)

    return sorted(tuple(value(v) for v in row) for row in df.astype(object).itertuples(index=False))


def difference(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return f"{len(spark_df)} rows != {len(oracle_df)}"
    left, right = canonical(spark_df), canonical(oracle_df)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
