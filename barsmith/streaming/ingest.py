"""Landing files and ticks as streams into the bar store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barsmith.operators.bars import build_bars, dedupe_keep_last, merge_bars
from barsmith.operators.normalize import accepted, normalize
from barsmith.plans.upkeep import update_features
from barsmith.schema import KEYS, raw_schema
from barsmith.session import discard, scratch_table
from barsmith.sources.raw import RAW_OPTIONS
from barsmith.sources.store import Layout, upsert_bars

# Columns kept with bars that ticks are merged into.
FIRST, LAST = "first_tick", "last_tick"


def _upsert_once(
    batch: DataFrame, epoch: int, base: str, interval: str, layout: Layout, ntz: bool, features=None, merge=merge_bars
) -> None:
    """Upsert a streaming batch under an id that a restarted query gives it again.

    The batch is written first, so its stream plan runs once however often the
    upsert reads it. The features follow, also if only they were missing when the query died.
    """
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    stored = scratch_table(batch, "batch")
    if not stored.isEmpty():
        upsert_bars(spark, base, stored, interval, layout, ntz, batch_id=f"{query}-{epoch}", merge=merge)
        if features is not None:
            update_features(spark, base, features, stored, interval, layout, ntz)
    discard(stored)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    interval: str = "1d",
    fmt: str = "json",
    layout: Layout = Layout(),
    ntz: bool = False,
    files_per_batch: int = 1000,
    features: str | None = None,
) -> StreamingQuery:
    """Upsert every landing file not seen yet, then stop.

    With `features`, a second store, the bars' features are kept up to date there.

    There is no watermark: a corrected bar counts however late it comes. A bar without a
    time or a price never enters, nor replaces a good one. A batch
    that is repeated after a failure has the same id, so the store takes it once.
    """
    raw = (
        spark.readStream.schema(raw_schema(interval))
        .options(**RAW_OPTIONS, maxFilesPerTrigger=files_per_batch)
        .format(fmt)
        .load(landing)
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("_file_time"),
            F.col("_metadata.file_path").alias("_file"),
        )
    )

    def upsert(batch: DataFrame, epoch: int) -> None:
        stamped = accepted(normalize(batch, interval, ntz=ntz, extra=["_file_time", "_file"]))
        # Within a batch the newest file wins; within a file the tie-break does.
        newest = dedupe_keep_last(stamped, ["_file_time", "_file"]).drop("_file_time", "_file")
        _upsert_once(newest, epoch, base, interval, layout, ntz, features)

    return (
        raw.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_bars(
    ticks: DataFrame,
    base: str,
    checkpoint: str,
    interval: str = "1h",
    delay: str = "1 hour",
    order=("timestamp",),
    layout: Layout = Layout(),
    ntz: bool = False,
) -> StreamingQuery:
    """Build bars from a tick stream and keep the store up to date.

    Each batch emits the bars it changed, in full, and upserts them. Ticks more
    than `delay` behind the newest one may no longer change their bar: `dropped` counts
    what was left out, and `rebuild_bars` repairs such bars from stored ticks.
    """
    bars = build_bars(ticks.withWatermark("timestamp", delay), interval, order)

    def upsert(batch: DataFrame, epoch: int) -> None:
        if ntz:
            batch = batch.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        _upsert_once(batch, epoch, base, interval, layout, ntz)

    return (
        bars.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def tick_layout(layout: Layout) -> Layout:
    """The layout of bars that ticks are merged into: with the times of their first and last tick."""
    return Layout(layout.by, layout.buckets, (FIRST, LAST))


def _partial_bars(ticks: DataFrame, interval: str) -> DataFrame:
    """Bars of some of the ticks, and when (microseconds) the first and last of them were."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp")).cast("double")
    times = {FIRST: F.min("_at"), LAST: F.max("_at")}
    return build_bars(ticks.withColumn("_at", micros), interval, more=times)


def _merge_partial(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Bars of all ticks from bars of some and of others."""
    both = existing.unionByName(batch.select(*existing.columns))
    return both.groupBy(*KEYS).agg(
        F.min_by("open", FIRST).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", LAST).alias("close"),
        F.sum("volume").alias("volume"),
        F.min(FIRST).alias(FIRST),
        F.max(LAST).alias(LAST),
    )


def stream_ticks(
    ticks: DataFrame,
    base: str,
    checkpoint: str,
    interval: str = "1h",
    layout: Layout = Layout(),
    ntz: bool = False,
    features: str | None = None,
) -> StreamingQuery:
    """Merge a tick stream into stored bars; no tick is too late.

    Each batch becomes bars of its own ticks, which are merged with the stored ones: a bar keeps the
    times of its first and last tick for that. The store is the state, so there is no watermark
    and nothing to rebuild, and late ticks cost the partitions of their bars. A batch that is
    repeated after a failure counts once. Of ticks with the same time any may open or close a bar.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        bars = _partial_bars(batch.where(F.col("timestamp").isNotNull()), interval)
        if ntz:
            bars = bars.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        _upsert_once(bars, epoch, base, interval, tick_layout(layout), ntz, features, _merge_partial)

    return (
        ticks.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dropped(query: StreamingQuery) -> int:
    """What the query's recent batches left out as too late.

    Spark counts after the tasks' own sums: several ticks of one bar in a task are one.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def rebuild_bars(
    ticks: DataFrame,
    base: str,
    interval: str = "1h",
    order=("timestamp",),
    layout: Layout = Layout(),
    ntz: bool = False,
) -> None:
    """Replace stored bars by those of the ticks, late ones included; give whole bars' ticks."""
    bars = build_bars(ticks, interval, order)
    if ntz:
        bars = bars.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    upsert_bars(ticks.sparkSession, base, bars, interval, layout, ntz)
