"""Raw provider columns to canonical bars."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barsmith.functions.scalar import parse_utc
from barsmith.schema import BAR_COLUMNS, PRICES, nan_to_null, require_columns

# Provider column names and ours.
RENAMES = {
    "Date": "timestamp",
    "Datetime": "timestamp",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Ticker": "symbol",
}


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RENAMES)


def flatten_columns(df: DataFrame) -> DataFrame:
    """Two-level names such as `('Close', 'AAPL')` become their first level.

    Where the first level is empty the second one is used.
    """

    def flat(name: str) -> str:
        pair = re.fullmatch(r"\('(.*)', '(.*)'\)", name)
        return (pair[1] or pair[2]) if pair else name

    return df.toDF(*[flat(c) for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def find_timestamp_col(df: DataFrame) -> str:
    """The leftmost column with a date or a timestamp in its name; without one, the leftmost."""
    dated = re.compile("date|timestamp", re.IGNORECASE)
    return min(df.columns, key=lambda column: dated.search(column) is None)


def to_utc(df: DataFrame, column: str = "timestamp", zone: str | None = None, ntz: bool = False) -> DataFrame:
    """Text or timestamps to UTC. Text without an offset is UTC, or in `zone`."""
    kind = df.schema[column].dataType
    value: Column = F.col(column)
    if isinstance(kind, T.StringType):
        value = parse_utc(value, zone)
    elif zone:
        value = F.to_utc_timestamp(value.cast("timestamp"), zone)
    return df.withColumn(column, value.cast("timestamp_ntz" if ntz else "timestamp"))


def tag(df: DataFrame, symbol: str | None = None, interval: str | None = None) -> DataFrame:
    """Constant symbol and interval columns; None leaves the column as it is."""
    constants = {"symbol": symbol, "interval": interval}
    return df.withColumns({k: F.lit(v) for k, v in constants.items() if v is not None})


def select_bars(df: DataFrame, extra=()) -> DataFrame:
    """The eight bar columns, numbers as double; only `extra` is kept besides."""
    numbers = [F.col(c).cast("double").alias(c) for c in [*PRICES, "volume"]]
    return df.select("timestamp", *numbers, "symbol", "interval", *extra)


def normalize(
    df: DataFrame, interval: str, symbol: str | None = None, zone=None, ntz=False, extra=()
) -> DataFrame:
    """Raw provider frame to canonical bars."""
    named = tag(normalize_columns(flatten_columns(df)), symbol, interval)
    if "timestamp" not in named.columns:
        named = named.withColumnRenamed(find_timestamp_col(named), "timestamp")
    require_columns(named, BAR_COLUMNS)
    return nan_to_null(select_bars(to_utc(named, zone=zone, ntz=ntz), extra))


def wide_to_long(df: DataFrame, tickers: list[str], time_column: str = "Date") -> DataFrame:
    """One row per ticker from columns named `Field_TICKER`.

    A ticker has no row for a time at which all its fields are missing.
    """
    fields = ["Open", "High", "Low", "Close", "Volume"]
    rows = [
        F.struct(
            F.lit(t).alias("Ticker"), *[F.col(f"`{f}_{t}`").cast("double").alias(f) for f in fields]
        )
        for t in tickers
    ]
    return df.select(time_column, F.inline(F.array(*rows))).dropna("all", subset=fields)


def _reason() -> Column:
    keyless = F.col("timestamp").isNull() | F.col("symbol").isNull() | F.col("interval").isNull()
    priceless = F.greatest(*[F.col(c).isNull() for c in PRICES])
    return F.when(keyless, "no time, symbol or interval").when(priceless, "unreadable price")


def accepted(df: DataFrame) -> DataFrame:
    """Bars that may enter the store: with their whole key and all four prices.

    A bar without a time has no place there, and one without a price must not replace a
    stored one.
    """
    return df.where(_reason().isNull())


def rejects(df: DataFrame) -> DataFrame:
    """The other bars, each with the reason."""
    return df.withColumn("reason", _reason()).where(F.col("reason").isNotNull())


def with_partitions(df: DataFrame, interval: str) -> DataFrame:
    """Integer year and month (and day for hourly bars) of the UTC timestamp."""
    parts = {"year": F.year("timestamp"), "month": F.month("timestamp")}
    if interval == "1h":
        parts["day"] = F.dayofmonth("timestamp")
    return df.withColumns(parts)
