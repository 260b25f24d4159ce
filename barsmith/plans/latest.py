"""The newest candles for a list of requested symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.operators.select import allow_symbols, last_period, reject_symbols
from barsmith.operators.summary import latest_nested
from barsmith.sources.raw import with_fallback
from barsmith.sources.store import read_latest

# How far back the second source is asked.
FALLBACK_PERIODS = {"1h": "1d", "1d": "30d"}


def latest_response(
    requests: DataFrame,
    universe: DataFrame,
    bars: DataFrame,
    second: DataFrame | None = None,
    interval: str = "1h",
    n: int = 120,
) -> DataFrame:
    """One row per requested symbol: its candles oldest first, or why there are none.

    Symbols without stored bars are looked up in the second source.
    """
    asked = requests.select("symbol").distinct()
    allowed = allow_symbols(asked, universe)
    found = allow_symbols(bars.where(F.col("interval") == interval), allowed)
    if second is not None:
        second = allow_symbols(second.where(F.col("interval") == interval), allowed)
        found = with_fallback(found, last_period(second, FALLBACK_PERIODS[interval]))
    missing = F.when(F.col("candles").isNull(), "no data")
    answered = allowed.join(latest_nested(found, n), "symbol", "left").select(
        "symbol", F.lit(interval).alias("interval"), "candles", missing.alias("error")
    )
    refused = reject_symbols(asked, universe).withColumn("interval", F.lit(interval))
    return answered.unionByName(refused, allowMissingColumns=True)


def stored_response(
    spark: SparkSession,
    requests: DataFrame,
    universe: DataFrame,
    base: str,
    second: DataFrame | None = None,
    interval: str = "1h",
    n: int = 120,
    *,
    asof,
    **options,
) -> DataFrame:
    """`latest_response` from the store's newest bars up to `asof`."""
    bars = read_latest(spark, base, interval, n, asof=asof, **options)
    return latest_response(requests, universe, bars, second, interval, n)
