"""Run a query in Spark and its SQL in DuckDB and compare all values."""
from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        values = frame[column]
        if values.dtype == object or str(values.dtype) in ("str", "string"):
            frame[column] = ["\0" if v is None or v is pd.NA or v != v else str(v)
                             for v in values]
        else:
            frame[column] = values.astype("float64").fillna(-9.87654321e12).round(9) + 0.0
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str:
    """Empty if the two hold the same rows, else what differs."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    a, b = _plain(left), _plain(right)
    for column in a.columns:
        if a[column].dtype != b[column].dtype:
            return f"type of {column}: {left[column].dtype} != {right[column].dtype}"
    unequal = (a != b).any(axis=1)
    if not unequal.any():
        return ""
    return (f"{int(unequal.sum())} rows differ\n{a[unequal].head(4).to_string()}\n"
            f"{b[unequal].head(4).to_string()}")
