"""Further indicators: RSI, Bollinger bands, price position, volume profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec, functions as F

from barsmith.operators.features import full_frame, returns
from barsmith.operators.recurrence import CHUNK, smoothed
from barsmith.operators.series import SeriesPlan, over_series, plan_series
from barsmith.schema import series_keys
from barsmith.session import sized_side


def rsi(df: DataFrame, n: int = 14, plan: SeriesPlan | None = None) -> DataFrame:
    """Relative strength from plain averages of the last n gains and losses.

    NULL until n changes are known, and when none of them moved the price.
    """

    def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("_move", F.col("close") - F.lag("close").over(w))
        # greatest() skips NULLs, so a missing move must stay missing here.
        d = d.withColumns(
            {
                "_gain": F.when(F.col("_move").isNotNull(), F.greatest("_move", F.lit(0.0))),
                "_loss": F.when(F.col("_move").isNotNull(), F.greatest(-F.col("_move"), F.lit(0.0))),
            }
        )
        gain, loss = full_frame(F.avg, "_gain", n, w), full_frame(F.avg, "_loss", n, w)
        return d.withColumns({"_up": gain, "_down": loss})

    moved = over_series(df, compute, n + 1, plan=plan)
    return moved.select(
        *df.columns, (F.try_divide("_up", F.col("_up") + F.col("_down")) * 100).alias("rsi")
    )


def rsi_wilder(
    df: DataFrame, n: int = 14, plan: SeriesPlan | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Relative strength from Wilder's averages, each of which takes in all bars before.

    NULL until n changes are known, on a bar whose change is unknown, and while no change moved
    the price. Long series are cut into chunks; the values do not depend on where.
    """
    plan = plan or plan_series(df)

    def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumn("_move", F.col("close") - F.lag("close").over(w))

    moved = over_series(df, compute, 2, plan=plan)
    known = F.col("_move").isNotNull()
    sides = {
        "_up": F.when(known, F.greatest("_move", F.lit(0.0))),
        "_down": F.when(known, F.greatest(-F.col("_move"), F.lit(0.0))),
    }
    averages = smoothed(moved, sides, n, plan, chunk)
    return averages.select(
        *df.columns, (F.try_divide("_up", F.col("_up") + F.col("_down")) * 100).alias("rsi_wilder")
    )


def bollinger(
    df: DataFrame, n: int = 20, width: float = 2.0, plan: SeriesPlan | None = None
) -> DataFrame:
    """Moving average and the bands `width` population deviations around it."""

    def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns(
            {
                "bb_middle": full_frame(F.avg, "close", n, w),
                "_dev": full_frame(F.stddev_pop, "close", n, w),
            }
        )

    return (
        over_series(df, compute, n, plan=plan)
        .withColumns(
            {
                "bb_upper": F.col("bb_middle") + width * F.col("_dev"),
                "bb_lower": F.col("bb_middle") - width * F.col("_dev"),
            }
        )
        .drop("_dev")
    )


def price_position(df: DataFrame, n: int = 20, plan: SeriesPlan | None = None) -> DataFrame:
    """Where the close lies between the bands: 0 at the lower, 1 at the upper."""
    span = F.col("bb_upper") - F.col("bb_lower")
    return bollinger(df, n, plan=plan).withColumn(
        "price_position", F.try_divide(F.col("close") - F.col("bb_lower"), span)
    )


def momentum(df: DataFrame, n: int = 12, plan: SeriesPlan | None = None) -> DataFrame:
    """Rate of change over n bars."""
    return returns(df, (n,), plan).withColumnRenamed(f"ret{n}", f"momentum{n}")


def volume_profile(df: DataFrame, buckets: int = 10) -> DataFrame:
    """Volume traded in equal price buckets between a series' lowest and highest close."""
    keys = series_keys(df)
    ranges = df.groupBy(*keys).agg(F.min("close").alias("_low"), F.max("close").alias("_high"))
    width = (F.col("_high") - F.col("_low")) / F.lit(float(buckets))
    step = F.coalesce(F.try_divide(F.col("close") - F.col("_low"), width), F.lit(0.0))
    bucket = F.least(F.floor(step), F.lit(buckets - 1)).cast("int")
    return (
        df.where(F.col("close").isNotNull())
        .join(sized_side(ranges), keys)
        .groupBy(*keys, bucket.alias("bucket"), "_low", width.alias("_width"))
        .agg(F.sum("volume").alias("volume"), F.count("*").alias("bars"))
        .select(
            *keys,
            "bucket",
            (F.col("_low") + F.col("bucket") * F.col("_width")).alias("price_from"),
            "volume",
            "bars",
        )
    )
