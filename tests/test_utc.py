"""Bars with time zones (TIMESTAMP), from landing file to score."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from barsmith.operators import features as X, model as M, select as L
from barsmith.operators.series import plan_series
from barsmith.plans.ingest import ingest
from barsmith.plans.scoring import score_latest
from barsmith.plans.training import train_report
from barsmith.sources import store as P
from helpers import pandas_labels, same, to_spark, walk


def test_from_file_to_score(spark, tmp_path):
    frames = [walk("A", 500, 1), walk("B", 500, 2)]
    landing, base = str(tmp_path / "landing"), str(tmp_path / "store")
    to_spark(spark, *frames).select(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd"), F.lit("T03:00:00+03:00")).alias("Date"),
        *[F.col(c).alias(c.capitalize()) for c in ["open", "high", "low", "close"]],
        F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Ticker"),
    ).write.option("header", True).csv(landing)
    ingest(spark, landing, base, "1d", "backfill", asof="2021-05-15")
    bars = P.read_bars(spark, base, "1d")
    assert dict(bars.dtypes)["timestamp"] == "timestamp"
    want = pd.concat([pandas_labels(f) for f in frames])
    same(X.labelled_features(bars).toPandas(), want)
    same(X.labelled_features(bars, plan_series(bars, max_rows=60)).toPandas(), want)

    recent = P.recent_bars(spark, base, "1d", dt.datetime(2021, 5, 15), 12)
    assert recent.agg(F.min("timestamp").cast("string")).first()[0] == "2020-05-15 00:00:00"
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "(((year" in plan.split("PartitionFilters")[1]
    assert L.last_hours(recent, 12).count() == 2

    models, report = train_report(recent, "2021-05-15")
    assert report.count() == 2
    scores = score_latest(recent, models, "2021-05-15")
    assert M.check_predictions(scores).count() == 0
    assert {r["status"] for r in scores.collect()} == {"ok"}
    assert P.read_latest(spark, base, "1d", 7, asof="2021-05-15").count() == 14
