"""Stored features that follow the stored bars, correction by correction.

A changed bar changes the features of itself and of the 19 bars after it, as far as the longest frame
reaches; a feature row's next close changes if the next bar with features does. Only these rows
are computed again, from the months around them, and only their partitions are written.

Months are read for each symbol with a changed bar: three before the change and two after, at first. A
run of months read without a gap is an island. If an island turns out too short (too few bars
before the change, or no row with features on either side) its symbols' months are read again, twice as
far, until the island is long enough or ends where the store ends. So values are exact for
symbols with few bars, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barsmith.operators.features import WARM_UP, _features, drop_incomplete, labelled_features, add_features
from barsmith.operators.series import MAX_SERIES_ROWS, next_in_series, plan_series
from barsmith.schema import BAR_COLUMNS, FEATURE_COLUMNS
from barsmith.session import discard, scratch_table, sized_side
from barsmith.sources.snapshots import latest
from barsmith.sources.store import LITERALS, Layout, _month_number, read_bars, upsert_bars, write_bars

NEXT = "close_t1"
STORED = (*FEATURE_COLUMNS, NEXT)
BEFORE, AFTER = 3, 2


def feature_layout(layout: Layout) -> Layout:
    """The layout of the features of a store's bars."""
    if layout.by != "bucket":
        raise ValueError("features are kept in a store filed by buckets")
    return Layout(layout.by, layout.buckets, STORED)


def read_features(spark: SparkSession, base: str, interval: str, layout: Layout = Layout(), **options) -> DataFrame:
    """Stored bars with their features and the next close, NULL for a symbol's last; options as for `read_bars`."""
    return read_bars(spark, base, interval, layout=feature_layout(layout), **options)


def with_label(features: DataFrame) -> DataFrame:
    """Stored features as training rows: as `labelled_features` gives them."""
    known = features.where(F.col(NEXT).isNotNull())
    return known.withColumn("label", (F.col(NEXT) > F.col("close")).cast("int"))


def build_features(spark: SparkSession, bars: str, features: str, interval: str, layout: Layout = Layout(), ntz=False) -> None:
    """Compute the features of all stored bars and write them anew. Long series are cut."""
    rows = read_bars(spark, bars, interval, layout=layout, ntz=ntz)
    plan = plan_series(rows)
    full = scratch_table(add_features(rows, plan), "features")
    keys = ["symbol", "interval", "timestamp"]
    labelled = labelled_features(rows, plan).select(*keys, NEXT)
    write_bars(full.join(labelled, keys, "left"), features, interval, feature_layout(layout), "static")
    discard(full)


def update_features(
    spark: SparkSession,
    bars: str,
    features: str,
    batch: DataFrame,
    interval: str,
    layout: Layout = Layout(),
    ntz: bool = False,
) -> dict[str, int]:
    """Bring the stored features up to date after `batch` was merged into the stored bars.

    Safe to repeat. Returns how many partitions of bars were read and of features written; -1 if all were
    computed anew: there were none yet, or one symbol has more changed bars than a task should hold.
    """
    there = latest(spark, bars.rstrip("/"))
    if there is None or not there.partitions:
        return {"read": 0, "written": 0}
    touched = scratch_table(batch.select("symbol", "timestamp").distinct(), "touched")
    if touched.isEmpty():
        return {"read": 0, "written": 0}
    largest = touched.groupBy("symbol").count().agg(F.max("count")).first()[0]
    if latest(spark, features.rstrip("/")) is None or largest > MAX_SERIES_ROWS:
        build_features(spark, bars, features, interval, layout, ntz)
        return {"read": -1, "written": -1}

    months = sorted({_number(p) for p in there.partitions})
    pending = touched.select("symbol", _month_number(F.col("timestamp")).alias("month")).distinct()
    back, ahead, read, parts = BEFORE, AFTER, set(), []
    while True:
        rows, opened = _islands(spark, bars, interval, layout, ntz, pending, back, ahead, months)
        read |= opened
        found = scratch_table(_changed(rows, touched), "changed")
        parts.append(found.where("_enough"))
        short = found.where(~F.col("_enough")).select("symbol", "_island").distinct()
        if short.isEmpty():
            break
        # an island's months are those of the changed bars in it and what was read around them
        short = found.where(~F.col("_enough") & F.col("_touched")).select("symbol", _month_number(F.col("timestamp")).alias("month"))
        pending = scratch_table(short.distinct(), "pending")
        back, ahead = 2 * back, 2 * ahead
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    # wider islands may hold what others have settled; both are exact
    changes = changes.where(F.col("_changed")).dropDuplicates(["symbol", "timestamp"])
    before = latest(spark, features.rstrip("/")).partitions
    upsert_bars(spark, features, changes, interval, feature_layout(layout), ntz, merge=_replaced)
    after = latest(spark, features.rstrip("/")).partitions
    discard(touched)
    return {"read": len(read), "written": sum(before.get(p) != g for p, g in after.items())}


def _number(partition: str) -> int:
    parts = dict(p.split("=", 1) for p in partition.split("/"))
    return int(parts["year"]) * 12 + int(parts["month"])


def _islands(spark, bars, interval, layout, ntz, pending, back, ahead, months) -> tuple[DataFrame, set]:
    """Bars of the months around the pending ones, with island, and whether it ends where the store does."""
    reach = F.sequence(F.greatest(F.col("month") - back, F.lit(months[0])), F.least(F.col("month") + ahead, F.lit(months[-1])))
    wanted = pending.select("symbol", F.explode(reach).alias("_month")).distinct()
    by_symbol = Window.partitionBy("symbol").orderBy("_month")
    wanted = wanted.withColumn("_island", F.col("_month") - F.row_number().over(by_symbol))
    island = Window.partitionBy("symbol", "_island")
    wanted = scratch_table(
        wanted.withColumns(
            {
                "_at_start": F.min("_month").over(island) <= months[0],
                "_at_end": F.max("_month").over(island) >= months[-1],
            }
        ),
        "wanted",
    )
    rows = read_bars(spark, bars, interval, layout=layout, ntz=ntz, folders=True)
    number = F.col("year") * 12 + F.col("month")
    opened = set()
    for column, values in (
        (number, wanted.select("_month")),
        (F.col("bucket"), wanted.select(layout.bucket(F.col("symbol")))),
    ):
        values = [r[0] for r in values.distinct().limit(LITERALS + 1).collect()]
        if len(values) <= LITERALS:  # prunes folders
            rows = rows.where(column.isin(values))
    opened = {tuple(r) for r in wanted.select(layout.bucket(F.col("symbol")), "_month").distinct().collect()}
    rows = rows.withColumn("_month", number).join(wanted, ["symbol", "_month"])
    return rows.select(*BAR_COLUMNS, "_island", "_at_start", "_at_end"), opened


def _changed(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows with features, which of them changed, and whether their island is long enough to tell."""
    mark = touched.select("symbol", "timestamp", F.lit(True).alias("_mark"))
    rows = rows.join(mark, ["symbol", "timestamp"], "left").withColumn("_touched", F.col("_mark").isNotNull()).drop("_mark")
    series = Window.partitionBy("symbol", "_island")
    w = series.orderBy("timestamp")
    rows = rows.withColumns(
        {
            "_place": F.row_number().over(w),
            "_affected": F.max("_touched").over(w.rowsBetween(-WARM_UP, 0)),
        }
    )
    rows = _features(rows, w)
    whole = [F.col(c).isNotNull() & ~F.isnan(c) for c in (*FEATURE_COLUMNS, "open", "high", "low", "close", "volume")]
    complete = whole[0]
    for test in whole[1:]:
        complete = complete & test
    rows = rows.withColumns(
        {
            "_complete": complete,
            # frames of the first rows reach back beyond the island
            "_exact": (F.col("_place") > WARM_UP + 1) | F.col("_at_start"),
            "_upto": F.sum(F.col("_affected").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    first, last = F.min(F.when(F.col("_affected"), F.col("_place"))), F.max(F.when(F.col("_affected"), F.col("_place")))
    rows = rows.withColumns({"_first": first.over(series), "_last": last.over(series), "_all": F.max("_upto").over(series)})
    sound = F.col("_complete") & F.col("_exact")
    rows = rows.withColumns(
        {
            "_enough": (F.col("_at_start") | F.max(sound & (F.col("_place") < F.col("_first"))).over(series))
            & (F.col("_at_end") | F.max(sound & (F.col("_place") > F.col("_last"))).over(series)),
        }
    )
    # The next row with features, and whether an affected bar lies up to it.
    full = Window.partitionBy("symbol", "_island", "_complete").orderBy("timestamp")
    rows = rows.withColumns({NEXT: F.lead("close").over(full), "_next": F.coalesce(F.lead("_upto").over(full), F.col("_all"))})
    changed = F.col("_affected") | (F.col("_complete") & (F.col("_next") > F.col("_upto")))
    kept = [*BAR_COLUMNS, *STORED, "_island", "_touched", "_complete", "_enough"]
    return rows.select(*kept, (changed & F.col("_exact")).alias("_changed")).where(F.col("_changed") | F.col("_touched"))


def _replaced(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored rows without the changed ones, and those of the changed ones that have features."""
    keys = ["symbol", "interval", "timestamp"]
    left = existing.join(sized_side(changes.select(*keys)), keys, "left_anti")
    return left.unionByName(changes.where("_complete").select(*left.columns))
