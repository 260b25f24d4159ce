"""Random series: cutting changes nothing, and symbols do not touch each other."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st

from barsmith.operators import features as X
from barsmith.operators.series import plan_series, series_position
from helpers import pandas_labels, same, to_spark, walk

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(
    sizes=st.lists(st.integers(1, 160), min_size=1, max_size=3),
    max_rows=st.integers(1, 90),
    holes=st.integers(0, 30),
    seed=st.integers(0, 10_000),
)
def test_cutting_changes_nothing(spark, sizes, max_rows, holes, seed):
    rng = np.random.default_rng(seed)
    frames = []
    for i, n in enumerate(sizes):
        frame = walk(f"S{i}", n, seed + i, gaps=bool(rng.integers(2)))
        frame.loc[rng.integers(0, n, min(holes, n // 4)), "close"] = np.nan
        frames.append(frame)
    bars = to_spark(spark, *frames)
    plan = plan_series(bars, max_rows=max_rows)
    assert plan.split == (max(sizes) > max_rows)
    same(X.labelled_features(bars, plan).toPandas(), pd.concat([pandas_labels(f) for f in frames]))
    placed = series_position(bars, plan).toPandas().sort_values(["symbol", "timestamp"])
    for i, n in enumerate(sizes):
        assert placed[placed["symbol"] == f"S{i}"]["position"].tolist() == list(range(n))
