"""Row selection: universes, time windows, latest bars, splits."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from barsmith.functions.scalar import parse_symbols
from barsmith.schema import DEFAULT_SYMBOLS, at, months_back, series_keys
from barsmith.session import sized_side

# Spark limits rows per group before the shuffle only up to so many.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64


def symbol_universe(spark, text: str = DEFAULT_SYMBOLS) -> DataFrame:
    """The symbols of a comma-separated list, as a frame."""
    return spark.range(1).select(F.explode(parse_symbols(F.lit(text))).alias("symbol"))


def allow_symbols(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows whose symbol is in the universe."""
    return df.join(sized_side(universe.select("symbol").distinct()), "symbol", "left_semi")


def reject_symbols(requests: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows whose symbol is not in the universe, with the reason."""
    known = sized_side(universe.select("symbol").distinct())
    return requests.join(known, "symbol", "left_anti").withColumn(
        "error", F.lit("symbol not allowed")  # fixed value
    )


def of_symbol(df: DataFrame, symbol: str, interval: str | None = None) -> DataFrame:
    picked = df.where(F.col("symbol") == symbol)
    return picked.where(F.col("interval") == interval) if interval else picked


def last_months(df: DataFrame, asof, months: int = 12) -> DataFrame:
    """Bars since `asof` less a number of calendar months, up to `asof`."""
    return up_to(df, asof).where(F.col("timestamp") >= at(df, months_back(asof, months)))


def up_to(df: DataFrame, asof) -> DataFrame:
    """What is known at a moment: bars of that time or before."""
    return df.where(F.col("timestamp") <= at(df, asof))


def _within(df: DataFrame, cutoffs: DataFrame, keep: Column) -> DataFrame:
    # Cutoffs are one row per series; the bars themselves are not shuffled.
    return df.join(sized_side(cutoffs), series_keys(df)).where(keep).select(*df.columns)


def last_hours(df: DataFrame, hours: int = 12) -> DataFrame:
    """Bars strictly after each symbol's last time less `hours`; all if >= 24."""
    if hours >= 24:
        return df
    back = F.make_dt_interval(hours=F.lit(hours))
    cutoffs = df.groupBy(*series_keys(df)).agg((F.max("timestamp") - back).alias("_cutoff"))
    return _within(df, cutoffs, F.col("timestamp") > F.col("_cutoff"))


def last_period(df: DataFrame, period: str, asof=None) -> DataFrame:
    """`5d`: each symbol's last 5 dates with bars. `2mo`, `1y`: calendar time to asof.

    With `asof`, bars after it do not count.
    """
    match = re.fullmatch(r"([1-9]\d*)(d|mo|y)", period)
    if not match:
        raise ValueError(f"unknown period: {period}")
    n, unit = int(match[1]), match[2]
    if unit != "d":
        if asof is None:
            raise ValueError(f"period {period} needs asof")
        return last_months(df, asof, n * (12 if unit == "y" else 1))
    df = df if asof is None else up_to(df, asof)
    keys = series_keys(df)
    dates = df.select(*keys, F.to_date("timestamp").alias("_date")).distinct()
    newest = Window.partitionBy(*keys).orderBy(F.desc("_date"))
    dates = dates.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n)
    cutoffs = dates.groupBy(*keys).agg(F.min("_date").alias("_cutoff"))
    return _within(df, cutoffs, F.to_date("timestamp") >= F.col("_cutoff"))


def min_history(df: DataFrame, rows: int = 200) -> DataFrame:
    """Bars of symbols with at least `rows` of them."""
    keys = series_keys(df)
    enough = row_counts(df).where(F.col("rows") >= rows).select(*keys)
    return df.join(sized_side(enough), keys, "left_semi")


def time_split(df: DataFrame, days: int = 90) -> DataFrame:
    """`split` is test for bars within `days` of the symbol's last, else train."""
    back = F.make_dt_interval(days=F.lit(days))
    keys = series_keys(df)
    cutoffs = df.groupBy(*keys).agg((F.max("timestamp") - back).alias("_cutoff"))
    side = F.when(F.col("timestamp") <= F.col("_cutoff"), "train").otherwise("test")
    return df.join(sized_side(cutoffs), keys).select(*df.columns, side.alias("split"))


def require_both_splits(df: DataFrame) -> DataFrame:
    """Rows of symbols that have both training and test rows."""
    keys = series_keys(df)
    sides = df.groupBy(*keys).agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )
    both = sides.where((F.col("train") > 0) & (F.col("test") > 0)).select(*keys)
    return df.join(sized_side(both), keys, "left_semi")


def latest_n(df: DataFrame, n: int = 120) -> DataFrame:
    """Each symbol's n newest bars; order the result by time where it is shown."""
    if n < 1:
        raise ValueError("n must be at least 1")

    def newest(d: DataFrame, *by) -> DataFrame:
        w = Window.partitionBy(*series_keys(df), *by).orderBy(F.desc("timestamp"))
        return d.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")

    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        # No limit before the shuffle here: thin out slices of each symbol first.
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64("timestamp"), F.lit(SALTS)))
        df = newest(sliced, "_slice").drop("_slice")
    return newest(df)


def latest_row(df: DataFrame) -> DataFrame:
    return latest_n(df, 1)


def data_range(df: DataFrame) -> DataFrame:
    return df.groupBy(*series_keys(df)).agg(
        F.count("*").alias("rows"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def max_timestamp(df: DataFrame) -> DataFrame:
    return df.groupBy(*series_keys(df)).agg(F.max("timestamp").alias("max_timestamp"))


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*series_keys(df)).agg(F.count("*").alias("rows"))
