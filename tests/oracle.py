"""Compares registered queries with their SQL on DuckDB over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_float_dtype(frame[c]):
            frame[c] = frame[c].round(6) + 0.0
        frame[c] = frame[c].map(lambda v: "" if v is None or (isinstance(v, float) and v != v) else repr(list(v)) if hasattr(v, "__len__") and not isinstance(v, str) else str(v))
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(spark_frame, con, sql: str) -> str:
    """What differs, or nothing."""
    expected, found = con.execute(sql).df(), spark_frame.toPandas()
    if sorted(expected.columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)}, expected {sorted(expected.columns)}"
    if len(expected) != len(found):
        return f"{len(found)} rows, expected {len(expected)}"
    kinds = {c: (found[c].dtype.kind, expected[c].dtype.kind) for c in found.columns}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1] and set(k) <= set("iuf") and not found[c].isna().any()}
    if wrong:
        return f"types {wrong}"
    a, b = normal(found), normal(expected)
    rows = (a != b).any(axis=1)
    return f"{int(rows.sum())} rows differ:\n{a[rows].head(4)}\n{b[rows].head(4)}" if rows.any() else ""
