import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.functions import scalar as S
from barsmith.operators.features import add_features, returns
from barsmith.operators.indicators import rsi
from barsmith.operators.series import plan_series
from barsmith.operators import normalize as N, select as L, summary as D
from barsmith.schema import nan_to_null, require_columns
from barsmith.session import scratch_dir, sized_side
from barsmith.sources import raw as R
from helpers import same, to_spark, walk


def test_latest_n(spark):
    frames = [walk("A", 50, 1), walk("B", 3, 2), walk("C", 1500, 3)]
    bars = to_spark(spark, *frames)
    for n in (1, 4, 1200):
        same(L.latest_n(bars, n).toPandas(), pd.concat([f.tail(n) for f in frames]))
    with pytest.raises(ValueError):
        L.latest_n(bars, 0)
    plan = L.latest_n(bars, 120)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_months_end_on_the_last_day(spark):
    days = pd.concat([walk("A", 400, 1, start="2019-12-31")])
    got = L.last_months(to_spark(spark, days), "2020-03-31", 1).toPandas()
    assert got["timestamp"].min() == pd.Timestamp("2020-02-29")


def test_periods(spark):
    bars = to_spark(spark, walk("A", 30, 1), walk("B", 30, 2, gaps=True))
    five = L.last_period(bars, "5d").groupBy("symbol").count().collect()
    assert {r["count"] for r in five} == {5}
    assert L.last_period(bars, "1y", "2021-01-10").count() < 60
    for wrong in ("5x", "0d", "d"):
        with pytest.raises(ValueError):
            L.last_period(bars, wrong)
    with pytest.raises(ValueError):
        L.last_period(bars, "2mo")


def test_last_hours_is_strict(spark):
    rows = [("A", dt.datetime(2024, 1, 1, h)) for h in range(20)]
    bars = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz")
    assert L.last_hours(bars, 12).count() == 12
    assert L.last_hours(bars, 24).count() == 20


def test_splits(spark):
    bars = to_spark(spark, walk("A", 200, 1), walk("B", 60, 2))
    split = L.time_split(bars, 90)
    got = {(r["symbol"], r["split"]): r["count"] for r in split.groupBy("symbol", "split").count().collect()}
    assert got == {("A", "train"): 110, ("A", "test"): 90, ("B", "test"): 60}
    assert {r[0] for r in L.require_both_splits(split).select("symbol").distinct().collect()} == {"A"}
    assert L.min_history(bars, 200).count() == 200


def test_universe(spark):
    bars = to_spark(spark, walk("A", 5), walk("Z", 5))
    known = L.symbol_universe(spark, "A, ,B,")
    assert L.symbol_universe(spark).count() == 7
    assert L.allow_symbols(bars, known).count() == 5
    rejected = L.reject_symbols(spark.sql("SELECT explode(array('A', 'Q')) AS symbol"), known).collect()
    assert [(r["symbol"], r["error"]) for r in rejected] == [("Q", "symbol not allowed")]
    assert R.with_fallback(bars.where("symbol = 'A'"), bars).count() == 10


def test_only_small_sides_are_broadcast(spark, tmp_path):
    spark.range(5000).write.parquet(str(tmp_path / "rows"))
    rows, side = spark.read.parquet(str(tmp_path / "rows")), sized_side(spark.range(5000))
    plan = lambda: rows.join(side, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100)
    try:
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scalars(spark):
    df = spark.createDataFrame([(x,) for x in (1.25e9, 3.44e6, 5600.0, 12.345, 0.0, None)], "x double")
    got = [r[0] for r in df.select(S.format_compact(F.col("x"))).collect()]
    assert got == ["1.3B", "3.4M", "5.6K", "12.35", "0.00", None]
    df = spark.createDataFrame([(x,) for x in (1234.5, -0.5, None)], "x double")
    assert [r[0] for r in df.select(S.format_usd(F.col("x"))).collect()] == ["$1,234.50", "-$0.50", None]
    assert [r[0] for r in df.select(S.format_pct(F.col("x") / 100)).collect()] == ["+12.35%", "-0.01%", None]
    df = spark.createDataFrame([(x,) for x in (0.0, 0.3, 0.4, 0.41, 0.6, 0.7, 0.71)], "p double")
    p = F.col("p")
    rows = df.select(S.signal(p), S.signal_strict(p), S.confidence(p)).collect()
    assert [r[0] for r in rows] == ["sell", "sell", "sell", "hold", "buy", "buy", "buy"]
    assert [r[1] for r in rows] == ["sell", "hold", "hold", "hold", "hold", "hold", "buy"]
    assert [r[2] for r in rows] == ["high", "medium", "medium", "low", "medium", "medium", "high"]
    one = spark.range(1)
    assert one.select(S.parse_symbols(F.lit(" AAPL ,,MSFT, "))).first()[0] == ["AAPL", "MSFT"]
    assert one.select(S.iso_utc(F.lit("2025-10-07 15:30:00").cast("timestamp"))).first()[0] == "2025-10-07T15:30:00+00:00"


def test_summary(spark):
    a, lone, zero = walk("A", 150, 1), walk("LONE", 1, 2), walk("ZERO", 2, 3)
    zero.loc[0, "close"] = 0.0
    a.loc[149, "volume"] = None
    bars = to_spark(spark, a, lone, zero)
    got = D.market_summary(bars).toPandas().set_index("symbol")
    assert got.loc["A", "bars"] == 120
    assert got.loc["A", "last_price"] == a["close"].iloc[-1]
    assert got.loc["A", "change_pct"] == pytest.approx((a["close"].iloc[-1] / a["close"].iloc[-2] - 1) * 100)
    assert got.loc["A", "total_volume"] == a["volume"].tail(120).sum()
    assert got.loc["LONE", "change_pct"] == 0 and got.loc["ZERO", "change_pct"] == 0
    nested = {r["symbol"]: r["candles"] for r in D.latest_nested(bars, 5).collect()}
    assert [c["close"] for c in nested["A"]] == a["close"].tail(5).tolist()
    card = D.signal_card(
        spark.createDataFrame([("A", 0.615, "buy"), ("B", 0.59, "hold"), ("C", 0.605, None)], "symbol string, prob_up double, signal string")
    ).collect()
    assert [tuple(r)[1:] for r in card] == [("BUY", "62%", "61.5%", True), ("HOLD", "59%", "59.0%", False), ("HOLD", "61%", "60.5%", True)]


def test_normalize(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, float("nan"), 9.0, 100)],
        "`('Date', '')` string, `('Open', 'X')` double, `('High', 'X')` double, `('Low', 'X')` double, "
        "`('Close', 'X')` double, `('Adj Close', 'X')` double, `('Volume', 'X')` long",
    )
    got = N.normalize(raw, "1d", symbol="X", ntz=True)
    assert got.columns == ["timestamp", "open", "high", "low", "close", "volume", "symbol", "interval"]
    row = got.first()
    assert row["timestamp"] == dt.datetime(2024, 1, 2) and row["close"] is None and row["volume"] == 100.0
    assert N.find_timestamp_col(spark.sql("SELECT 1 AS a, 2 AS TradeDate")) == "TradeDate"
    assert N.find_timestamp_col(spark.sql("SELECT 1 AS a, 2 AS b")) == "a"
    assert N.lower_columns(spark.sql("SELECT 1 AS Abc")).columns == ["abc"]
    with pytest.raises(ValueError, match="low"):
        require_columns(spark.sql("SELECT 1 AS timestamp, 1 AS open, 1 AS high, 1 AS close"))


def test_to_utc(spark):
    rows = [("2024-07-01T10:00:00",), ("2024-07-01T10:00:00+02:00",), ("2024-07-01T10:00:00Z",), ("2024-07-01",)]
    df = spark.createDataFrame(rows, "timestamp string")
    utc = [r[0].isoformat() for r in N.to_utc(df, ntz=True).collect()]
    assert utc == ["2024-07-01T10:00:00", "2024-07-01T08:00:00", "2024-07-01T10:00:00", "2024-07-01T00:00:00"]
    zoned = [r[0].isoformat() for r in N.to_utc(df, zone="America/New_York", ntz=True).collect()]
    assert zoned == ["2024-07-01T14:00:00", "2024-07-01T08:00:00", "2024-07-01T10:00:00", "2024-07-01T04:00:00"]


def test_wide_to_long(spark):
    wide = spark.createDataFrame(
        [("2024-01-01", *[1.0] * 5, *[2.0] * 5), ("2024-01-02", *[3.0] * 5, *[None] * 5)],
        "Date string, " + ", ".join(f"{f}_{t} double" for t in ("A", "B") for f in ("Open", "High", "Low", "Close", "Volume")),
    )
    got = N.wide_to_long(wide, ["A", "B"]).select("Date", "Ticker", "Close").collect()
    assert sorted(map(tuple, got)) == [("2024-01-01", "A", 1.0), ("2024-01-01", "B", 2.0), ("2024-01-02", "A", 3.0)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "a double, b string")
    assert [r[0] for r in nan_to_null(df).collect()] == [None, 1.0]


def test_nothing_after_asof(spark):
    bars = to_spark(spark, walk("A", 400, 1))
    for got in (L.last_months(bars, "2020-06-01", 2), L.last_period(bars, "5d", "2020-06-01"), L.last_period(bars, "1mo", "2020-06-01")):
        assert got.agg(F.max("timestamp")).first()[0] == dt.datetime(2020, 6, 1)
    assert L.last_period(bars, "5d", "2020-06-01").count() == 5


def test_hourly_and_daily_bars_of_a_symbol_are_two_series(spark):
    daily, hourly = walk("A", 40, 1), walk("A", 60, 2).assign(interval="1h")
    both = to_spark(spark, daily, hourly)
    apart = to_spark(spark, daily), to_spark(spark, hourly)
    for f in (lambda d: L.latest_n(d, 4), lambda d: L.latest_n(d, 2000), lambda d: L.last_period(d, "3d"), lambda d: L.min_history(d, 50),
              lambda d: L.time_split(d, 10), add_features, rsi):
        want = sorted(map(str, [r for d in apart for r in f(d).collect()]))
        assert sorted(map(str, f(both).collect())) == want


def test_aggregates_keep_intervals_apart(spark):
    daily = to_spark(spark, walk("A", 5, 1))
    both = daily.unionByName(daily.limit(2).withColumn("interval", F.lit("1h")))
    counts = lambda df: {r["interval"]: r["rows"] for r in df.collect()}
    assert counts(L.data_range(both)) == counts(L.row_counts(both)) == {"1d": 5, "1h": 2}
    assert L.max_timestamp(both).count() == 2
    assert {r["interval"]: r["bars"] for r in D.market_summary(both).collect()} == {"1d": 5, "1h": 2}


def test_bars_without_a_time_enter_no_series(spark):
    frame = walk("A", 400, 1)
    bars = to_spark(spark, frame, frame.head(1).assign(timestamp=pd.NaT))
    for rows in (1_000_000, 50):  # uncut, and cut into blocks
        got = returns(bars, plan=plan_series(bars, max_rows=rows))
        assert got.count() == 400 and got.where("ret1 is not null").count() == 399
