"""Small bar frames, and their features by pandas as the yardstick."""

from __future__ import annotations

import numpy as np
import pandas as pd

from barsmith.schema import bar_schema


def walk(symbol: str, n: int, seed: int = 0, start="2020-01-01", gaps: bool = False) -> pd.DataFrame:
    """n daily bars; with `gaps` whole weeks and months are missing."""
    rng = np.random.default_rng(seed)
    steps = rng.choice([1, 1, 1, 2, 9, 45], n) if gaps else np.ones(n, int)
    close = 50 + np.abs(np.cumsum(rng.normal(0, 1, n))) + rng.random(n)
    return pd.DataFrame(
        {
            "timestamp": pd.Timestamp(start) + pd.to_timedelta(np.cumsum(steps), unit="D"),
            "open": close - 0.5,
            "high": close + 1,
            "low": close - 1,
            "close": close,
            "volume": rng.integers(1, 100, n).astype(float),
            "symbol": symbol,
            "interval": "1d",
        }
    )


def to_spark(spark, *frames: pd.DataFrame):
    """Missing values become NULL, but for the symbol NAN they stay NaN."""

    def value(v, symbol):
        if v is pd.NaT:
            return None
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime()
        return None if isinstance(v, float) and np.isnan(v) and symbol != "NAN" else v

    rows = [
        tuple(value(v, r.symbol) for v in r) for r in pd.concat(frames).itertuples(index=False)
    ]
    return spark.createDataFrame(rows, bar_schema(ntz=True))


def pandas_features(bars: pd.DataFrame) -> pd.DataFrame:
    """One symbol's feature rows, straight from the definitions."""
    d = bars.sort_values("timestamp", ignore_index=True)
    c = d["close"]
    for n in (1, 5, 10):
        d[f"ret{n}"] = c / c.shift(n) - 1
    for n in (5, 10, 20):
        d[f"sma{n}"] = c.rolling(n).mean()
        d[f"dist_sma{n}"] = c / d[f"sma{n}"] - 1
    d["vol10"] = d["ret1"].rolling(10).std()
    return d.dropna(ignore_index=True)


def pandas_labels(bars: pd.DataFrame) -> pd.DataFrame:
    d = pandas_features(bars)
    d["close_t1"] = d["close"].shift(-1)
    d["label"] = (d["close_t1"] > d["close"]).astype(int)
    return d.dropna(ignore_index=True)


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    keys = ["symbol", "timestamp"]
    columns = sorted(want.columns)
    got, want = (f[columns].sort_values(keys, ignore_index=True) for f in (got, want))
    got["timestamp"] = got["timestamp"].astype("datetime64[us]")
    want["timestamp"] = want["timestamp"].astype("datetime64[us]")
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=1e-10)
