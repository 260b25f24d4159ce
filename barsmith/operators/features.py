"""Rolling features and next-bar labels, per symbol and by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from barsmith.operators.series import (
    BLOCK,
    CORE,
    SeriesPlan,
    next_in_series,
    over_series,
    plan_series,
    spread_windows,
)
from barsmith.schema import BAR_COLUMNS, FEATURE_COLUMNS

WARM_UP = 19  # bars before the first one with every feature


def change(n: int, w: WindowSpec) -> Column:
    """Relative change of the close over n bars; NULL on a zero base."""
    return F.try_divide("close", F.lag("close", n).over(w)) - 1


def full_frame(agg, column: str, n: int, w: WindowSpec) -> Column:
    """`agg` over the last n rows, NULL until the frame holds n values."""
    last_n = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(column).over(last_n) == n, agg(column).over(last_n))


def off_mean(n: int) -> Column:
    return F.try_divide("close", f"sma{n}") - 1


def returns(df: DataFrame, lags=(1, 5, 10), plan: SeriesPlan | None = None) -> DataFrame:
    return over_series(
        df, lambda d, w: d.withColumns({f"ret{n}": change(n, w) for n in lags}), max(lags), plan=plan
    )


def sma(df: DataFrame, sizes=(5, 10, 20), plan: SeriesPlan | None = None) -> DataFrame:
    return over_series(
        df,
        lambda d, w: d.withColumns({f"sma{n}": full_frame(F.avg, "close", n, w) for n in sizes}),
        max(sizes),
        plan=plan,
    )


def dist_sma(df: DataFrame, sizes=(5, 10, 20), plan: SeriesPlan | None = None) -> DataFrame:
    return sma(df, sizes, plan).withColumns({f"dist_sma{n}": off_mean(n) for n in sizes})


def volatility(df: DataFrame, n: int = 10, plan: SeriesPlan | None = None) -> DataFrame:
    """Sample deviation of the last n one-bar returns."""

    def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("_ret", change(1, w))
        return d.withColumn(f"vol{n}", full_frame(F.stddev_samp, "_ret", n, w)).drop("_ret")

    return over_series(df, compute, n + 1, plan=plan)


def _features(d: DataFrame, w: WindowSpec) -> DataFrame:
    # Both steps use one window specification: one exchange, one sort.
    # Rows without 20 closes go anyway, so only the longest frame is counted.
    levels = {f"ret{n}": change(n, w) for n in (1, 5, 10)}
    levels |= {f"sma{n}": F.avg("close").over(w.rowsBetween(1 - n, 0)) for n in (5, 10)}
    levels["sma20"] = full_frame(F.avg, "close", 20, w)
    ratios = {f"dist_sma{n}": off_mean(n) for n in (5, 10, 20)}
    ratios["vol10"] = full_frame(F.stddev_samp, "ret1", 10, w)
    return d.withColumns(levels).withColumns(ratios)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a missing value in any bar or feature column."""
    columns = [c for c in [*BAR_COLUMNS, *FEATURE_COLUMNS, "close_t1"] if c in df.columns]
    return df.dropna("any", subset=columns)  # NaN counts as missing here, too


def add_features(df: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """The ten feature columns; bars in the warm-up are removed."""
    return drop_incomplete(over_series(df, _features, 20, plan=plan))


def next_close(df: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    return over_series(
        df, lambda d, w: d.withColumn("close_t1", F.lead("close").over(w)), ahead=1, plan=plan
    )


def _label(df: DataFrame) -> DataFrame:
    higher = F.col("close_t1") > F.col("close")
    return drop_incomplete(df).withColumn("label", higher.cast("int"))


def make_label(df: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """1 if the next bar of this frame closes higher, else 0; the last bar goes."""
    return _label(next_close(df, plan))


def labelled_features(df: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """`add_features`, then `make_label` on the bars that remain."""
    plan = plan or plan_series(df)
    if not plan.split:
        return make_label(add_features(df, plan), plan)
    remaining = drop_incomplete(_features(*spread_windows(df, plan, 20)).where(CORE)).drop(CORE)
    return _label(next_in_series(remaining, "close", "close_t1", plan)).drop(BLOCK)
