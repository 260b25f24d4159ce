"""Stored features after corrections, next to features of the whole store."""

import numpy as np
import pandas as pd
import pytest

from barsmith.operators.features import add_features, labelled_features
from barsmith.plans import upkeep as K
from barsmith.sources import store as P
from helpers import to_spark, walk

LAYOUT = P.Layout(buckets=2)


def exact(got, want):
    columns = sorted(want.columns)
    got, want = (f.toPandas()[columns].sort_values(["symbol", "timestamp"], ignore_index=True) for f in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=1e-12)


def check(spark, bars, features):
    stored = K.read_features(spark, features, "1d", LAYOUT, ntz=True)
    whole = P.read_bars(spark, bars, "1d", layout=LAYOUT, ntz=True)
    exact(stored.drop(K.NEXT), add_features(whole))
    exact(K.with_label(stored), labelled_features(whole))


@pytest.fixture
def store(spark, tmp_path):
    bars, features = str(tmp_path / "bars"), str(tmp_path / "features")
    frames = [walk("A", 700, 1), walk("B", 420, 2, gaps=True), walk("C", 300, 3, gaps=True), walk("FEW", 12, 4)]
    P.write_bars(to_spark(spark, *frames), bars, "1d", LAYOUT)
    K.build_features(spark, bars, features, "1d", LAYOUT, ntz=True)
    return bars, features, pd.concat(frames)


def apply(spark, bars, features, batch):
    frame = to_spark(spark, batch)
    P.upsert_bars(spark, bars, frame, "1d", LAYOUT, ntz=True)
    return K.update_features(spark, bars, features, frame, "1d", LAYOUT, ntz=True)


def test_built_features(spark, store):
    check(spark, *store[:2])


def test_a_correction_opens_and_writes_few_folders(spark, store):
    bars, features, all_bars = store
    one = all_bars[(all_bars["symbol"] == "A")].iloc[[350]].assign(close=55.0)
    done = apply(spark, bars, features, one)
    assert done == {"read": 6, "written": 2}  # the month of the bar, three before and two after; 20 bars on
    check(spark, bars, features)


def test_random_corrections_and_new_bars(spark, store):
    bars, features, all_bars = store
    rng = np.random.default_rng(5)
    for step in range(2):
        changed = all_bars.sample(6, random_state=step)
        changed = changed.assign(close=rng.choice([0.0, 60.0, 61.5], len(changed)))  # a zero price has no features after it
        at = all_bars.sample(3, random_state=90 + step)
        added = at.assign(timestamp=at["timestamp"] + pd.Timedelta(hours=5), close=48.0 + step)
        late = walk("A", 2, 1, start=f"2022-0{step + 1}-01")
        apply(spark, bars, features, pd.concat([changed, added, late]))
        check(spark, bars, features)


def test_a_new_symbol_an_empty_batch_and_a_first_build(spark, store, tmp_path):
    bars, features, _ = store
    apply(spark, bars, features, walk("NEW", 45, 9, start="2020-08-01"))
    check(spark, bars, features)
    assert apply(spark, bars, features, walk("NEW", 45, 9).head(0)) == {"read": 0, "written": 0}
    other = str(tmp_path / "other")
    assert apply(spark, bars, other, walk("NEW", 1, 9))["written"] == -1
    check(spark, bars, other)


def test_all_feature_rows_of_a_partition_may_go(spark, tmp_path):
    bars, features = str(tmp_path / "bars"), str(tmp_path / "features")
    frame = walk("A", 31, 1)
    P.write_bars(to_spark(spark, frame), bars, "1d", LAYOUT)
    K.build_features(spark, bars, features, "1d", LAYOUT, ntz=True)
    apply(spark, bars, features, frame.assign(close=0.0))
    check(spark, bars, features)
