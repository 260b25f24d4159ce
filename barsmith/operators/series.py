"""Ordered work per symbol that stays parallel when one symbol is huge.

A window over `symbol` runs each symbol in one task. That is the best plan while
every series is of moderate length, and it is what `over_series` uses then. A
series with more than `max_rows` bars is cut into blocks of about that size:
runs of whole calendar units (months, days, ...) found from a small count per
(symbol, unit). The rows next to a block's edge, as many as the frame reaches
back or ahead, are repeated into the neighbouring block, so each block computes
exact values for its own rows. Nothing is sampled.

A bar without a time has no place in a series: it never enters one, cut or not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barsmith.schema import series_keys
from barsmith.session import discard, scratch_table, sized_side

MAX_SERIES_ROWS = 1_000_000
# A unit may hold at most this share of a block; the repeated rows are whole units.
UNIT_SHARE = 8
UNITS = ["month", "day", "hour", "minute", "second"]

BLOCK, CORE = "_block", "_core"


@dataclass(frozen=True)
class SeriesPlan:
    """Where each series is cut. `units` is None when no series needs cutting."""

    keys: list[str] = field(default_factory=lambda: ["symbol"])
    max_rows: int = MAX_SERIES_ROWS
    unit: str | None = None
    units: DataFrame | None = None

    @property
    def split(self) -> bool:
        return self.units is not None


def plan_series(
    df: DataFrame, keys=None, max_rows: int = MAX_SERIES_ROWS
) -> SeriesPlan:
    """Count the rows of each series and cut those with more than `max_rows`.

    One count of the rows if no series is that long; on a store partitioned by symbol it
    reads no column data.
    """
    keys = list(keys or series_keys(df))
    df = timed(df)
    long = sized_side(df.groupBy(*keys).count().where(F.col("count") > max_rows).select(*keys))
    if long.isEmpty():
        return SeriesPlan(keys, max_rows)

    # The rows are counted once, by the finest unit; the others add those counts up.
    finest = scratch_table(_count(df.join(long, keys, "left_semi"), keys, "timestamp", UNITS[-1], F.count("*")))
    for unit in UNITS:
        counts = _count(finest, keys, "_unit", unit, F.sum("n"))
        largest = counts.agg(F.max("n")).first()[0]
        if largest <= max(max_rows // UNIT_SHARE, 1):
            break

    by_unit = Window.partitionBy(*keys).orderBy("_unit")
    start = F.sum("n").over(by_unit) - F.col("n")
    units = counts.select(
        *keys,
        "_unit",
        "n",
        start.alias("start"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    ).withColumn(BLOCK, F.floor(F.col("start") / max_rows))
    in_block = Window.partitionBy(*keys, BLOCK)
    units = scratch_table(
        units.withColumns(
            {
                "block_start": F.min("start").over(in_block),
                "block_end": F.max(F.col("start") + F.col("n")).over(in_block),
            }
        ),
        "series-blocks",
    )
    discard(finest)
    return SeriesPlan(keys, max_rows, unit, units)


def timed(df: DataFrame) -> DataFrame:
    """Bars with a time."""
    return df.where(F.col("timestamp").isNotNull())


def _unit(unit: str, moment: str = "timestamp") -> Column:
    return F.date_trunc(unit, F.col(moment))


def _count(df: DataFrame, keys: list[str], moment: str, unit: str, rows: Column) -> DataFrame:
    """Rows `n` of each series and calendar unit."""
    return df.select("*", _unit(unit, moment).alias("_in")).groupBy(*keys, F.col("_in").alias("_unit")).agg(rows.alias("n"))


def spread(df: DataFrame, plan: SeriesPlan, back: int = 0, ahead: int = 0) -> DataFrame:
    """Add the block of each row, and repeat the rows near an edge.

    A row goes to every later block that starts fewer than `back` rows after the
    row's unit ends, and to every earlier block that ends fewer than `ahead` rows
    before the unit starts. `_core` marks the one copy in the row's own block.
    """
    own = F.struct(F.col(BLOCK).alias(BLOCK), F.lit(True).alias(CORE))
    targets = [F.array(own)]
    by_unit = Window.partitionBy(*plan.keys).orderBy("_unit")
    # Units are never empty, so at most `back` (or `ahead`) of them are in reach.
    if back:
        near = F.collect_list(F.struct(BLOCK, F.col("block_start").alias("at")))
        near = near.over(by_unit.rowsBetween(1, back))
        end = F.col("start") + F.col("n")
        targets.append(_reached(near, lambda b: b["at"] < end + back))
    if ahead:
        near = F.collect_list(F.struct(BLOCK, F.col("block_end").alias("at")))
        near = near.over(by_unit.rowsBetween(-ahead, -1))
        targets.append(_reached(near, lambda b: b["at"] > F.col("start") - ahead))
    blocks = plan.units.select(*plan.keys, "_unit", F.concat(*targets).alias("_targets"))

    whole = F.array(F.struct(F.lit(None).cast("bigint").alias(BLOCK), F.lit(True).alias(CORE)))
    return (
        df.withColumn("_unit", _unit(plan.unit))
        .join(blocks, [*plan.keys, "_unit"], "left")
        .select(*df.columns, F.inline(F.coalesce("_targets", whole)))
    )


def _reached(near: Column, test: Callable[[Column], Column]) -> Column:
    others = F.filter(near, lambda b: (b[BLOCK] != F.col(BLOCK)) & test(b))
    blocks = F.array_distinct(F.transform(others, lambda b: b[BLOCK]))
    return F.transform(blocks, lambda b: F.struct(b.alias(BLOCK), F.lit(False).alias(CORE)))


def over_series(
    df: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int = 0,
    ahead: int = 0,
    plan: SeriesPlan | None = None,
) -> DataFrame:
    """Apply `compute(df, window)`, whose frames reach `back` and `ahead` rows."""
    df = timed(df)
    plan = plan or plan_series(df)
    if not plan.split:
        return compute(df, Window.partitionBy(*plan.keys).orderBy("timestamp"))
    return compute(*spread_windows(df, plan, back, ahead)).where(CORE).drop(BLOCK, CORE)


def spread_windows(
    df: DataFrame, plan: SeriesPlan, back: int = 0, ahead: int = 0
) -> tuple[DataFrame, WindowSpec]:
    """The spread frame, and the window over one block of it."""
    df = timed(df)
    window = Window.partitionBy(*plan.keys, BLOCK).orderBy("timestamp")
    return spread(df, plan, back, ahead), window


def next_in_series(rows: DataFrame, column: str, name: str, plan: SeriesPlan) -> DataFrame:
    """Add `column` of the next row, for rows with a block, one copy each.

    `rows` may have lost rows since it was spread, so a block's last row may find
    its next one in any later block. The first value of each block is a small
    table; only cut series are computed for it. `column` must not be NULL.
    """
    in_block = Window.partitionBy(*plan.keys, BLOCK).orderBy("timestamp")
    by_block = Window.partitionBy(*plan.keys).orderBy(BLOCK)
    cut = rows.where(F.col(BLOCK).isNotNull())
    firsts = cut.groupBy(*plan.keys, BLOCK).agg(F.min_by(column, "timestamp").alias("_first"))
    later = firsts.select(*plan.keys, BLOCK, F.lead("_first").over(by_block).alias("_later"))
    return (
        rows.withColumn(name, F.lead(column).over(in_block))
        .join(sized_side(later), [*plan.keys, BLOCK], "left")
        .select(*rows.columns, F.coalesce(name, "_later").alias(name))
    )


def series_position(df: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """Add `position` (0-based, by time) and `length` of the row's series."""
    df = timed(df)
    plan = plan or plan_series(df)
    if not plan.split:
        by_key = Window.partitionBy(*plan.keys)
        return df.withColumns(
            {
                "position": F.row_number().over(by_key.orderBy("timestamp")).cast("bigint") - 1,
                "length": F.count("*").over(by_key),
            }
        )
    starts = plan.units.select(*plan.keys, BLOCK, "block_start", "total").distinct()
    by_block = Window.partitionBy(*plan.keys, BLOCK)
    placed = spread(df, plan).withColumns(
        {
            "_rank": F.row_number().over(by_block.orderBy("timestamp")).cast("bigint") - 1,
            "_rows": F.count("*").over(by_block),
        }
    )
    return placed.join(starts, [*plan.keys, BLOCK], "left").select(
        *df.columns,
        (F.col("_rank") + F.coalesce("block_start", F.lit(0))).alias("position"),
        F.coalesce("total", "_rows").alias("length"),
    )
