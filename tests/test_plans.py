import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.operators.model import load_models, load_versions
from barsmith.plans.ingest import ingest, ingest_rejects
from barsmith.plans.latest import latest_response
from barsmith.plans.scoring import score_latest
from barsmith.plans.training import train_report, train_run
from barsmith.sources import store as P
from helpers import same, to_spark, walk

LAYOUT = P.Layout(buckets=2)


def land(spark, frame: pd.DataFrame, path: str) -> str:
    to_spark(spark, frame).select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("Date"),
        *[F.col(c).alias(c.capitalize()) for c in ["open", "high", "low", "close"]],
        F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Ticker"),
    ).write.mode("append").option("header", True).csv(path)
    return path


def test_backfill_then_updates(spark, tmp_path):
    base, first = str(tmp_path / "store"), walk("A", 900, 1)
    landing = land(spark, pd.concat([first, walk("SKIP", 5, 2)]), str(tmp_path / "one"))
    options = dict(symbols=["A"], layout=LAYOUT, ntz=True)
    summary = ingest(spark, landing, base, "1d", "backfill", asof="2022-06-18", **options).collect()
    first = first[(first["timestamp"] >= "2020-06-18") & (first["timestamp"] <= "2022-06-18")]
    assert [(r["symbol"], r["rows"]) for r in summary] == [("A", len(first))]
    newer = walk("A", 903, 1).tail(4).assign(close=3.0)
    landing = land(spark, newer, str(tmp_path / "two"))
    planned = ingest(spark, landing, base, "1d", dry_run=True, **options).collect()
    assert [(r["symbol"], r["rows"]) for r in planned] == [("A", 2)]
    ingest(spark, landing, base, "1d", **options)
    got = P.read_bars(spark, base, "1d", layout=LAYOUT, ntz=True).toPandas()
    same(got, pd.concat([first, newer.tail(2)]))
    with pytest.raises(ValueError):
        ingest(spark, landing, base, "1d", "other")


def test_latest_response(spark):
    bars, second = to_spark(spark, walk("A", 50, 1)), to_spark(spark, walk("A", 9, 2), walk("B", 60, 3))
    names = lambda *s: spark.createDataFrame([(x,) for x in s], "symbol string")
    answer = latest_response(names("A", "B", "C", "X"), names("A", "B", "C"), bars, second, "1d", 40)
    got = {r["symbol"]: (len(r["candles"] or []), r["error"]) for r in answer.collect()}
    assert got == {"A": (40, None), "B": (30, None), "C": (0, "no data"), "X": (0, "symbol not allowed")}


def test_unreadable_bars_stay_out(spark, tmp_path):
    base, landing = str(tmp_path / "store"), str(tmp_path / "landing")
    os.makedirs(landing)
    rows = ["2020-01-02,1,2,0.5,1.5,1.5,10,A", "2020-01-03,1,2,0.5,,1.5,10,A", "no date,1,2,0.5,1.5,1.5,10,A", "2020-01-04,1,2,0.5,1.5,1.5,10,"]
    with open(f"{landing}/a.csv", "w") as f:
        f.write("\n".join(["Date,Open,High,Low,Close,Adj Close,Volume,Ticker", *rows]))
    ingest(spark, landing, base, "1d", "backfill", asof="2020-02-01", layout=LAYOUT)
    assert P.read_bars(spark, base, "1d", layout=LAYOUT).count() == 1
    reasons = sorted(r["reason"] for r in ingest_rejects(spark, landing).collect())
    assert reasons == ["no time, symbol or interval"] * 2 + ["unreadable price"]


def test_training_run_saves_its_models(spark, tmp_path):
    path = str(tmp_path / "models")
    bars = to_spark(spark, walk("A", 400, 1), walk("007", 400, 2))
    report = train_run(bars, "2021-02-01", path, dry_run=True)
    assert report.count() == 2 and not os.path.exists(path)
    report = {r["symbol"]: r["model_path"] for r in train_run(bars, "2021-02-01", path).collect()}
    assert set(report) == {"A", "007"} and all(os.path.isdir(p) for p in report.values())
    assert {r["symbol"] for r in load_models(spark, path).collect()} == {"A", "007"}
    assert {str(r["trained_asof"]) for r in load_versions(spark, f"{path}-versions").collect()} == {"2021-02-01 00:00:00"}
    lines = [json.loads(r[0]) for r in spark.read.text(f"{path}-report").collect()]
    written = {symbol: entry for line in lines for symbol, entry in line.items()}
    assert {s: e["model_path"] for s, e in written.items()} == report and 0 <= written["A"]["metrics"]["accuracy"] <= 1
    assert train_run(bars, "2021-02-01", path, symbols=["A"], dry_run=True).count() == 1


def test_scores_of_a_past_day_know_no_later_bars(spark):
    frame = walk("A", 500, 1)
    models = train_report(to_spark(spark, frame), "2020-12-31")[0]
    past = frame[frame["timestamp"] <= "2020-12-31"]
    whole, cut = (score_latest(to_spark(spark, f), models, "2020-12-31").collect() for f in (frame, past))
    assert whole == cut and whole[0]["status"] == "ok"
    a, b = (train_report(to_spark(spark, f), "2020-12-31")[0].collect() for f in (frame, past))
    assert a == b
