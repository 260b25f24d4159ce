"""Ingest: landing files to the store, as a backfill or an update."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.operators.normalize import accepted, rejects
from barsmith.operators.select import last_hours, last_period
from barsmith.session import discard, scratch_table
from barsmith.sources.raw import raw_bars
from barsmith.sources.store import Layout, plan_write, upsert_bars, write_summary

# How much of the landing files each kind of run takes.
BACKFILL = {"1d": "2y", "1h": "30d"}
UPDATE = {"1d": "2d", "1h": "1d"}
UPDATE_HOURS = 12


def ingest(
    spark: SparkSession,
    landing: str,
    base: str,
    interval: str = "1d",
    kind: str = "update",
    symbols: list[str] | None = None,
    asof=None,
    hours: int = UPDATE_HOURS,
    fmt: str = "csv",
    layout: Layout = Layout(),
    ntz: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Upsert the newest part of the landing files; returns rows (and files) per symbol.

    A backfill takes two years of daily or thirty days of hourly bars; an update
    the last two days or, hourly, the last `hours` of the last day. With
    `dry_run` nothing is written and the rows are only counted. The landing files are
    parsed once. Bars without a time, symbol or price stay out; `ingest_rejects` has them.
    """
    if kind not in ("backfill", "update"):
        raise ValueError(f"unknown kind of ingest: {kind}")
    bars = raw_bars(spark, landing, fmt, interval, ntz=ntz)
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(symbols))
    landed = scratch_table(accepted(bars), "landed")
    bars = last_period(landed, (BACKFILL if kind == "backfill" else UPDATE)[interval], asof)
    if kind == "update" and interval == "1h":
        bars = last_hours(bars, hours)
    if dry_run:
        return plan_write(bars)
    upsert_bars(spark, base, bars, interval, layout, ntz)
    discard(landed)
    return write_summary(spark, base, interval, layout, ntz)


def ingest_rejects(
    spark: SparkSession, landing: str, interval: str = "1d", fmt: str = "csv", ntz: bool = False
) -> DataFrame:
    """Landed bars that an ingest leaves out, and why."""
    return rejects(raw_bars(spark, landing, fmt, interval, ntz=ntz))
