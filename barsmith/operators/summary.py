"""What a dashboard shows: candles, price summary, signal card."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barsmith.functions.scalar import format_compact, format_pct, format_usd, iso_utc
from barsmith.operators.select import latest_n
from barsmith.schema import PRICES, nan_to_null, require_columns, series_keys


def to_candles(df: DataFrame) -> DataFrame:
    """Bars for display: ISO timestamp text and double values."""
    require_columns(df)
    return df.select(
        "symbol",
        "interval",
        iso_utc(F.col("timestamp")).alias("timestamp"),
        *[F.col(c).cast("double").alias(c) for c in [*PRICES, "volume"]],
    )


def latest_nested(df: DataFrame, n: int = 120) -> DataFrame:
    """One row per symbol with its n newest candles, oldest first."""
    candle = F.struct("timestamp", *PRICES, "volume")
    return (
        to_candles(latest_n(df, n))
        .groupBy("symbol", "interval")
        .agg(F.sort_array(F.collect_list(candle)).alias("candles"))
    )


def market_summary(df: DataFrame, n: int = 120) -> DataFrame:
    """Of each series the last price, change on the bar before in percent, and volume of n bars."""
    keys = series_keys(df)
    by_time = Window.partitionBy(*keys).orderBy("timestamp")
    shown = nan_to_null(latest_n(df, n)).withColumn("_before", F.lag("close").over(by_time))
    per_series = shown.groupBy(*keys).agg(
        F.max_by(F.struct("close", "_before"), "timestamp").alias("newest"),
        F.sum(F.coalesce("volume", F.lit(0.0))).alias("total_volume"),
        F.count("*").alias("bars"),
    )
    last = F.col("newest.close")
    before = F.coalesce("newest._before", last)
    return per_series.select(
        *keys,
        "bars",
        last.alias("last_price"),
        F.coalesce(F.try_divide(last - before, before) * 100, F.lit(0.0)).alias("change_pct"),
        "total_volume",
    )


def price_card(summary: DataFrame) -> DataFrame:
    """The summary as display text."""
    return summary.select(
        "symbol",
        format_usd(F.col("last_price")).alias("price"),
        format_pct(F.col("change_pct")).alias("change"),
        format_compact(F.col("total_volume")).alias("volume"),
    )


def signal_card(predictions: DataFrame) -> DataFrame:
    """Signal text, confidence in percent, and whether to show it as positive."""
    percent = F.col("prob_up") * 100
    text = F.coalesce(F.upper("signal"), F.lit("HOLD"))
    return predictions.select(
        "symbol",
        text.alias("signal"),
        F.format_string("%d%%", F.floor(percent + 0.5)).alias("confidence"),
        F.format_string("%.1f%%", percent).alias("confidence_detail"),
        ((text == "BUY") | (percent > 60)).alias("positive"),
    )
