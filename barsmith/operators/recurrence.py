"""Exact linear recurrences along a series, in parallel.

`y = a * y(before) + x` makes of any run of rows one map, y -> A * y + B, and maps compose. A series is cut
into chunks of some thousand rows; each chunk's map is an aggregate; the maps are composed along the
series by doubling, which takes a few windows over one row a chunk; and each chunk is finished from its
start value. A series of any length is spread over many tasks, and the values are those of the
row-by-row recurrence but for rounding.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from barsmith.operators.series import SeriesPlan, plan_series, series_position
from barsmith.session import scratch_table

# Rows in a chunk, at most: within one, the powers of the factor must stay usable numbers, of which this
# is the logarithm of the smallest.
CHUNK, SMALLEST = 2048, -300.0


def smoothed(
    df: DataFrame, values: dict[str, Column], n: int, plan: SeriesPlan | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Add Wilder's average of each value: the plain mean of the first n, then y + (x - y) / n.

    A row on which any value is missing gets NULL and is passed over; so do the rows before the n-th.
    """
    if n < 2:
        raise ValueError("an average takes at least two values")
    plan = plan or plan_series(df)
    keys, keep = plan.keys, 1 - 1 / n
    chunk = min(chunk, int(SMALLEST / math.log(keep)))
    there = F.lit(True)
    for value in values.values():
        there = there & value.isNotNull()
    placed = series_position(df, plan).drop("length")
    rows = placed.withColumns(
        {"_chunk": F.floor(F.col("position") / chunk), "_counts": there.cast("int")}
        | {f"_x_{name}": F.when(there, value) for name, value in values.items()}
    ).drop("position")
    rows = scratch_table(rows, "chunks")

    # Before a chunk there are `_before` values; the first n are added up, later ones fade by `keep`.
    sizes = rows.groupBy(*keys, "_chunk").agg(F.sum("_counts").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    sizes = sizes.withColumn("_before", F.sum("_n").over(along) - F.col("_n"))
    by_chunk = Window.partitionBy(*keys, "_chunk").orderBy("timestamp")
    so_far = by_chunk.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(sizes, [*keys, "_chunk"])
    rows = rows.withColumn("_place", F.col("_before") + F.sum("_counts").over(so_far))
    faded = F.greatest(F.col("_place"), F.lit(n)) - F.greatest(F.col("_before"), F.lit(n))
    rows = rows.withColumn("_faded", faded)
    # Added up in units of the chunk's start, each value grows by what it has faded less.
    grown = {f"_s_{c}": F.sum(F.col(f"_x_{c}") / n / F.pow(F.lit(keep), F.col("_faded"))).over(so_far) for c in values}
    rows = rows.withColumns(grown)

    power = F.pow(F.lit(keep), F.max("_faded"))
    maps = rows.groupBy(*keys, "_chunk").agg(
        power.alias("_a"), *[(F.coalesce(F.max_by(f"_s_{c}", "timestamp"), F.lit(0.0)) * power).alias(f"_b_{c}") for c in values]
    )
    maps = scratch_table(maps, "maps")
    chunks = maps.agg(F.coalesce(F.max("_chunk"), F.lit(0))).first()[0] + 1
    step = 1
    while step < chunks:
        earlier = {c: F.lag(c, step).over(along) for c in ["_a", *[f"_b_{v}" for v in values]]}
        composed = {f"_b_{c}": F.col(f"_b_{c}") + F.coalesce(F.col("_a") * earlier[f"_b_{c}"], F.lit(0.0)) for c in values}
        maps = maps.withColumns(composed | {"_a": F.col("_a") * F.coalesce(earlier["_a"], F.lit(1.0))})
        step *= 2
    starts = maps.select(*keys, "_chunk", *[F.lag(f"_b_{c}", 1, 0.0).over(along).alias(f"_y_{c}") for c in values])
    known = (F.col("_counts") == 1) & (F.col("_place") >= n)
    fade = F.pow(F.lit(keep), F.col("_faded"))
    return rows.join(starts, [*keys, "_chunk"]).select(
        *df.columns, *[F.when(known, fade * (F.col(f"_y_{c}") + F.col(f"_s_{c}"))).alias(c) for c in values]
    )
