"""Tick frames (symbol, timestamp, price, size) from general tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Ranks the trades of a day; the shorter (order, line) key repeats.
TRADE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
]


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per order line: the part's brand at the line's unit price."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("p_brand").alias("symbol"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("size"),
        *TRADE_ORDER,
    )


def readings(events: DataFrame) -> DataFrame:
    """One tick per event: its type, time and value."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.lit(1.0).alias("size"),
    )
