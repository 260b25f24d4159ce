"""Schemas of bars, raw provider files, models and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

PRICES = ["open", "high", "low", "close"]
BAR_COLUMNS = ["timestamp", *PRICES, "volume", "symbol", "interval"]
KEYS = ["interval", "symbol", "timestamp"]
INTERVALS = {"1h": "1 hour", "1d": "1 day"}

# The default universe, the model inputs and all feature columns, in order.
DEFAULT_SYMBOLS = "AAPL,MSFT,AMZN,GOOGL,META,NVDA,TSLA"
FEATURES = ["ret1", "ret5", "ret10", "dist_sma5", "dist_sma10", "dist_sma20", "vol10"]
FEATURE_COLUMNS = [
    "ret1", "ret5", "ret10", "sma5", "sma10", "sma20",
    "dist_sma5", "dist_sma10", "dist_sma20", "vol10",
]


def bar_schema(ntz: bool = False) -> T.StructType:
    """Canonical bar; `ntz` keeps wall-clock timestamps as they are."""
    stamp = T.TimestampNTZType() if ntz else T.TimestampType()
    return T.StructType(
        [T.StructField("timestamp", stamp)]
        + [T.StructField(c, T.DoubleType()) for c in [*PRICES, "volume"]]
        + [T.StructField(c, T.StringType()) for c in ["symbol", "interval"]]
    )


def raw_schema(interval: str) -> T.StructType:
    """Provider file: the time column stays text until `to_utc` parses it."""
    return T.StructType(
        [T.StructField("Datetime" if interval == "1h" else "Date", T.StringType())]
        + [
            T.StructField(c, T.DoubleType())
            for c in ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
        ]
        + [T.StructField("Ticker", T.StringType())]
    )


def model_schema(keys: list[str], df: DataFrame) -> T.StructType:
    """One row per trained model, keyed like the training data."""
    return T.StructType(
        [df.schema[k] for k in keys]
        + [
            T.StructField("features", T.ArrayType(T.StringType())),
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("n_train", T.LongType()),
            T.StructField("n_iter", T.IntegerType()),
            T.StructField("status", T.StringType()),
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN apart from NULL; a missing value here is always NULL."""
    doubles = [f.name for f in df.schema if f.dataType in (T.DoubleType(), T.FloatType())]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in doubles})


def require_columns(df: DataFrame, columns=("timestamp", *PRICES, "volume")) -> DataFrame:
    """The frame, if it has the columns; else an error, before any job, that names all it lacks."""
    lacking = sorted(set(columns).difference(df.columns))
    if lacking:
        raise ValueError(f"columns not found: {', '.join(lacking)} (there are {', '.join(df.columns)})")
    return df


def series_keys(df: DataFrame) -> list[str]:
    """What tells one series of bars from another: hourly and daily bars of a symbol are two."""
    return [c for c in ("symbol", "interval") if c in df.columns]


def months_back(asof, months: int):
    """Calendar months before a moment; a missing day becomes the month's last."""
    return F.lit(asof).cast("timestamp_ntz") - F.make_interval(months=F.lit(months))


def at(df: DataFrame, moment, column: str = "timestamp"):
    """A literal moment in the type of the frame's time column."""
    return F.lit(moment).cast(df.schema[column].dataType)
