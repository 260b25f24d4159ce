"""Compare a registered query with its SQL twin, value by value."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _ready(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime64"):
            frame[column] = frame[column].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    found = []
    got, want = _ready(got), _ready(want)
    for column in got.columns:
        a, b = got[column], want[column]
        if a.dtype.kind != b.dtype.kind and a.notna().all() and b.notna().all():
            found.append(f"{column}: type {a.dtype} != {b.dtype}")
        unequal = ~((a == b) | (a.isna() & b.isna()))
        if unequal.any():
            at = np.flatnonzero(unequal)[:3]
            found.append(f"{column}: {unequal.sum()} values, {a[at].tolist()} != {b[at].tolist()}")
    return found
