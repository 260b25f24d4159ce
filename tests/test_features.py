import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.operators import bars as B, features as X, indicators as I
from barsmith.operators.model import cv_folds
from barsmith.operators.series import plan_series, series_position
from helpers import pandas_features, pandas_labels, same, to_spark, walk


def universe():
    holes = walk("HOLES", 120, 3)
    holes.loc[[40, 41, 90], "close"] = None
    nans = walk("NAN", 80, 4)
    nans.loc[30, "close"] = np.nan
    flat = walk("FLAT", 60, 5)
    flat.loc[30:35, "close"] = 55.0
    return [
        walk("LONG", 400, 1), walk("GAPS", 300, 2, gaps=True), holes, nans, flat,
        walk("SHORT", 19, 6), walk("EDGE", 20, 7), walk("TWENTYONE", 21, 8),
    ]


def test_features_match_the_definitions(spark):
    frames = universe()
    want = pd.concat([pandas_features(f) for f in frames])
    same(X.add_features(to_spark(spark, *frames)).toPandas(), want)


def test_warm_up(spark):
    bars = to_spark(spark, walk("SHORT", 19), walk("EDGE", 20), walk("MORE", 25))
    counts = {r["symbol"]: r["count"] for r in X.add_features(bars).groupBy("symbol").count().collect()}
    assert counts == {"EDGE": 1, "MORE": 6}


def test_labels_match_the_definitions(spark):
    frames = universe()
    want = pd.concat([pandas_labels(f) for f in frames])
    got = X.labelled_features(to_spark(spark, *frames))
    same(got.toPandas(), want)
    assert dict(got.dtypes)["label"] == "int"


@pytest.mark.parametrize("max_rows", [1, 7, 25, 100, 350])
def test_cut_series_give_the_same_rows(spark, max_rows):
    """Also with blocks far shorter than the frames, and with gaps in time."""
    frames = universe()
    bars = to_spark(spark, *frames)
    plan = plan_series(bars, max_rows=max_rows)
    assert plan.split
    same(X.add_features(bars, plan).toPandas(), pd.concat([pandas_features(f) for f in frames]))
    same(X.labelled_features(bars, plan).toPandas(), pd.concat([pandas_labels(f) for f in frames]))


def test_cut_series_next_close_and_indicators(spark):
    bars = to_spark(spark, walk("A", 200, 1, gaps=True), walk("B", 150, 2), walk("C", 5, 3))
    cut = plan_series(bars, max_rows=10)
    for operator in (X.next_close, X.returns, X.dist_sma, X.volatility, I.rsi, I.price_position, I.momentum):
        whole = operator(bars).orderBy("symbol", "timestamp").toPandas()
        pieces = operator(bars, plan=cut).orderBy("symbol", "timestamp").toPandas()
        pd.testing.assert_frame_equal(whole, pieces[whole.columns], rtol=1e-9)


def test_blocks_hold_about_max_rows(spark):
    from barsmith.operators.series import spread

    bars = to_spark(spark, walk("HOT", 2000, 1), walk("COLD", 30, 2))
    plan = plan_series(bars, max_rows=200)
    sizes = spread(bars, plan, back=20).groupBy("symbol", "_block").count().toPandas()
    assert sizes["count"].max() <= 200 + 2 * (200 // 8) + 20
    assert sizes[sizes["symbol"] == "HOT"].shape[0] >= 10
    assert sizes[sizes["symbol"] == "COLD"]["_block"].isna().all()


def test_one_shuffle_for_all_features(spark, tmp_path):
    to_spark(spark, walk("A", 50)).write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    rows = X.labelled_features(bars)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_zero_close_gives_no_row_with_it_as_base(spark):
    bars = walk("ZERO", 60)
    bars.loc[30, "close"] = 0.0
    got = X.add_features(to_spark(spark, bars)).toPandas()
    assert np.isfinite(got[X.FEATURE_COLUMNS]).all().all()
    left_out = set(bars["timestamp"][19:]) - set(got["timestamp"])
    # The bases of ret1, ret5 and ret10, and the ten returns behind vol10.
    assert left_out == set(bars["timestamp"][[*range(31, 41)]])


def test_positions_and_folds(spark):
    bars = to_spark(spark, walk("A", 203, 1), walk("B", 4, 2), walk("C", 77, 3, gaps=True))
    for plan in (plan_series(bars), plan_series(bars, max_rows=9)):
        placed = series_position(bars, plan).toPandas().sort_values(["symbol", "timestamp"])
        for symbol, n in (("A", 203), ("B", 4), ("C", 77)):
            part = placed[placed["symbol"] == symbol]
            assert part["position"].tolist() == list(range(n))
            assert set(part["length"]) == {n}
        tiles = cv_folds(bars, 5, plan).groupBy("symbol", "tile").count().toPandas()
        a = tiles[tiles["symbol"] == "A"].sort_values("tile")["count"].tolist()
        assert a == [34, 34, 34, 34, 34, 33]
        assert sorted(tiles[tiles["symbol"] == "B"]["tile"]) == [1, 2, 3, 4]


def test_rsi_by_hand(spark):
    bars = walk("A", 40, 9)
    flat = walk("FLAT", 30, 9)
    flat["close"] = 10.0
    got = I.rsi(to_spark(spark, bars, flat)).orderBy("timestamp").toPandas()
    move = bars["close"].diff()
    up, down = move.clip(lower=0).rolling(14).mean(), (-move).clip(lower=0).rolling(14).mean()
    np.testing.assert_allclose(got[got["symbol"] == "A"]["rsi"], 100 * up / (up + down), rtol=1e-9)
    assert got[got["symbol"] == "FLAT"]["rsi"].isna().all()


def test_volume_profile_keeps_all_volume(spark):
    bars = walk("A", 90, 2)
    flat = walk("FLAT", 30, 9)
    flat["close"] = 10.0
    got = I.volume_profile(to_spark(spark, bars, flat)).toPandas()
    edges = np.linspace(bars["close"].min(), bars["close"].max(), 11)
    want, _ = np.histogram(bars["close"], edges, weights=bars["volume"])
    a = got[got["symbol"] == "A"].set_index("bucket")["volume"].reindex(range(10), fill_value=0)
    np.testing.assert_allclose(a, want)
    assert got[got["symbol"] == "FLAT"][["bucket", "bars"]].values.tolist() == [[0, 30]]


def test_empty_input(spark):
    bars = to_spark(spark, walk("A", 5)).where(F.lit(False))
    assert X.labelled_features(bars).count() == 0
    assert I.volume_profile(bars).count() == 0


def plain_wilder(bars: pd.DataFrame, n: int = 14) -> list:
    """Row by row, from the definition."""
    out, up, down, known, before = [], 0.0, 0.0, 0, np.nan
    for close in bars.sort_values("timestamp")["close"]:
        move, before = close - before, close
        if np.isnan(move):
            out.append(np.nan)
            continue
        known += 1
        gain, loss = max(move, 0.0), max(-move, 0.0)
        if known <= n:
            up, down = up + gain / n, down + loss / n
        else:
            up, down = up + (gain - up) / n, down + (loss - down) / n
        out.append(100 * up / (up + down) if known >= n and up + down > 0 else np.nan)
    return out


@pytest.mark.parametrize("max_rows, chunk", [(10**6, 2048), (10**6, 7), (100, 50), (90, 3)])
def test_wilder_rsi_cut_and_uncut(spark, max_rows, chunk):
    frames = [walk("A", 700, 1, gaps=True), walk("B", 13, 2), walk("C", 15, 3), walk("FLAT", 30, 3).assign(close=5.0)]
    frames[0].loc[[5, 200, 201, 640], "close"] = np.nan
    frames[0].loc[300, "close"] = 0.0
    frames.append(pd.concat([walk("STOP", 40, 4), walk("STOP", 60, 5, start="2020-02-12").assign(close=7.0)]))
    bars = to_spark(spark, *frames)
    got = I.rsi_wilder(bars, plan=plan_series(bars, max_rows=max_rows), chunk=chunk).toPandas()
    for frame in frames:
        mine = got[got["symbol"] == frame["symbol"].iloc[0]].sort_values("timestamp")
        np.testing.assert_allclose(mine["rsi_wilder"].astype(float), plain_wilder(frame), rtol=1e-9, atol=1e-9)
    assert I.rsi_wilder(bars.limit(0)).count() == 0


def test_profile_and_resampling_keep_intervals_apart(spark):
    hourly = walk("A", 48, 1).assign(interval="1h")
    hourly["timestamp"] = pd.date_range("2020-01-01", periods=48, freq="h")
    daily = walk("A", 30, 2)
    both = to_spark(spark, hourly, daily)
    for name, frame in (("1h", hourly), ("1d", daily)):
        got = I.volume_profile(both).where(F.col("interval") == name).drop("interval")
        want = I.volume_profile(to_spark(spark, frame)).drop("interval")
        assert sorted(got.collect()) == sorted(want.collect())
    got, want = (B.resample(d).orderBy("timestamp").collect() for d in (both, to_spark(spark, hourly)))
    assert got == want and len(got) == 2
