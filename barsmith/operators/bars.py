"""Bars from ticks, coarser bars from bars, and merging bar versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barsmith.schema import BAR_COLUMNS, INTERVALS, KEYS, PRICES, series_keys


def _moment(columns) -> Column:
    # A single column keeps the aggregate hash-based; a struct makes Spark sort.
    columns = list(columns)
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def build_bars(ticks: DataFrame, interval: str, order=("timestamp",), more: dict[str, Column] | None = None) -> DataFrame:
    """Bars from (symbol, timestamp, price, size); `order` ranks ticks in a bar.

    `more` names further aggregates to keep with each bar.

    Each task aggregates its own ticks before the shuffle, so a symbol with most
    of the ticks costs no more than the others.
    """
    first = _moment(order)
    bucket = F.window("timestamp", INTERVALS[interval])
    return (
        ticks.groupBy("symbol", bucket.alias("bucket"))
        .agg(
            F.min_by("price", first).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", first).alias("close"),
            F.sum("size").cast("double").alias("volume"),
            *[aggregate.alias(name) for name, aggregate in (more or {}).items()],
        )
        .select(
            F.col("bucket.start").alias("timestamp"),
            *PRICES,
            "volume",
            "symbol",
            F.lit(interval).alias("interval"),
            *(more or {}),
        )
    )


def resample(bars: DataFrame, interval: str = "1d") -> DataFrame:
    """Coarser bars, e.g. daily from hourly; bars that are of that interval already do not count."""
    if "interval" in bars.columns:
        bars = bars.where(F.col("interval") != interval)
    return (
        bars.groupBy(*series_keys(bars), F.window("timestamp", INTERVALS[interval]).alias("bucket"))
        .agg(
            F.min_by("open", "timestamp").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "timestamp").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select(
            F.col("bucket.start").alias("timestamp"),
            *PRICES,
            "volume",
            "symbol",
            F.lit(interval).alias("interval"),
        )
    )


def union_bars(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, with `ingest_seq` telling the newer version of a bar."""
    older = existing.withColumn("ingest_seq", F.lit(0).cast("bigint"))
    if "ingest_seq" not in batch.columns:
        batch = batch.withColumn("ingest_seq", F.lit(1).cast("bigint"))
    return older.unionByName(batch, allowMissingColumns=True)


def dedupe_keep_last(df: DataFrame, order=("ingest_seq",), keys=KEYS) -> DataFrame:
    """One row per key: the last by `order`, ties broken by the bar's values.

    Spark limits each key to one row per task before the shuffle, so many copies
    of one bar never meet in one task.
    """
    ties = [c for c in [*PRICES, "volume"] if c in df.columns and c not in order]
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in [*order, *ties]])
    return df.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def merge_bars(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing and new bars together, each bar in its newest version."""
    return dedupe_keep_last(union_bars(existing, batch)).select(*BAR_COLUMNS)


def merge_stats(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows per series: existing, new, replaced, inserted, and after the merge."""
    series = series_keys(existing)
    keys = [*series, "timestamp"]
    old = existing.select(*keys, F.lit(1).alias("old"), F.lit(0).alias("new"))
    new = batch.select(*keys, F.lit(0).alias("old"), F.lit(1).alias("new"))
    per_bar = old.unionAll(new).groupBy(*keys).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    was, came = F.col("old") > 0, F.col("new") > 0
    return per_bar.groupBy(*series).agg(
        F.sum("old").alias("existing_rows"),
        F.sum("new").alias("new_rows"),
        F.count_if(was & came).alias("replaced_rows"),
        F.count_if(~was & came).alias("inserted_rows"),
        F.count("*").alias("merged_rows"),
    )
