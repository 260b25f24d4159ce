import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barsmith.operators import model as M
from barsmith.operators.asof import asof_join, valid_at
from barsmith.operators.features import add_features
from barsmith.plans.scoring import score_latest
from barsmith.plans.training import report_json, train_report
from barsmith.schema import FEATURES
from helpers import to_spark, walk


def samples(spark, sizes: dict[str, int], scale: float = 1.0):
    frames = []
    for i, (symbol, n) in enumerate(sizes.items()):
        rng = np.random.default_rng(i)
        x = rng.normal(0, scale, (n, len(FEATURES)))
        y = (x @ rng.normal(0, 1, len(FEATURES)) + rng.logistic(0, 1, n) > 0).astype(int)
        frames.append(pd.DataFrame(x, columns=FEATURES).assign(label=y, symbol=symbol))
    schema = ", ".join(f"{c} double" for c in FEATURES) + ", label int, symbol string"
    return spark.createDataFrame(pd.concat(frames), schema)


def table(models):
    return models.orderBy("symbol").toPandas().set_index("symbol")


def test_agrees_with_another_solver(spark):
    df = samples(spark, {"A": 300})
    ours = table(M.train_models(df)).loc["A"]
    theirs = LogisticRegression(
        regParam=1 / 300, elasticNetParam=0.0, standardization=False, tol=1e-12, maxIter=500
    ).fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df))
    np.testing.assert_allclose(ours["coef"], theirs.coefficients.toArray(), atol=1e-5)
    assert ours["intercept"] == pytest.approx(theirs.intercept, abs=1e-5)
    assert (ours["status"], ours["n_train"]) == ("ok", 300)


@pytest.mark.parametrize("scale", [1.0, 60.0, 1e-3])
def test_large_symbols_get_the_same_models(spark, scale):
    df = samples(spark, {"A": 300, "B": 40, "C": 500}, scale)
    usual, large = table(M.train_models(df)), table(M.train_models(df, max_rows=100))
    for symbol in "ABC":
        np.testing.assert_allclose(large["coef"][symbol], usual["coef"][symbol], rtol=1e-5, atol=1e-6)
        assert large["intercept"][symbol] == pytest.approx(usual["intercept"][symbol], abs=1e-5)
    assert large["n_train"].to_dict() == {"A": 300, "B": 40, "C": 500}
    assert set(large["status"]) == set(usual["status"]) == {"ok"}


def test_single_class_has_no_model(spark):
    df = samples(spark, {"A": 50, "B": 60})
    df = df.withColumn("label", F.when(F.col("symbol") == "B", 1).otherwise(F.col("label")))
    for models in (table(M.train_models(df)), table(M.train_models(df, max_rows=10))):
        assert models["status"].to_dict() == {"A": "ok", "B": "single_class"}
        assert models["coef"]["B"] is None


def test_prediction_matches_numpy(spark):
    df = samples(spark, {"A": 80, "B": 20})
    models = M.train_models(df.where("symbol = 'A'"))
    got = M.with_signal(M.predict_proba(df, models)).toPandas()
    model = table(models).loc["A"]
    a = got[got["symbol"] == "A"]
    want = 1 / (1 + np.exp(-(a[FEATURES].to_numpy() @ model["coef"] + model["intercept"])))
    np.testing.assert_allclose(a["prob_up"], want, rtol=1e-12)
    rule = np.where(want >= 0.6, "buy", np.where(want <= 0.4, "sell", "hold"))
    assert a["signal"].tolist() == rule.tolist()
    b = got[got["symbol"] == "B"]
    assert set(zip(b["prob_up"], b["signal"], b["status"])) == {(0.5, "hold", "no_model")}


def test_metrics(spark):
    rows = [("A", 1, 1), ("A", 1, 0), ("A", 0, 1), ("A", 1, 1), ("B", 0, 0), ("C", 1, 0), ("D", 1, None)]
    df = spark.createDataFrame(rows, "symbol string, label int, predicted int")
    got = {r["symbol"]: (r["accuracy"], r["f1"]) for r in M.metrics(df).collect()}
    assert got["A"] == (0.5, pytest.approx(2 * 2 / (2 * 2 + 2)))
    assert got["B"] == (1.0, 0.0)
    assert got["C"] == (0.0, 0.0)
    assert "D" not in got


def test_check_predictions(spark):
    rows = [("A", 0.5, "hold"), ("B", 1.2, "buy"), ("C", 0.1, "short"), ("D", None, "hold"), ("E", 0.0, "sell")]
    df = spark.createDataFrame(rows, "symbol string, prob_up double, signal string")
    assert {r["symbol"] for r in M.check_predictions(df).collect()} == {"B", "C", "D"}


def test_report_and_scores(spark):
    bars = to_spark(spark, walk("A", 500, 1), walk("B", 500, 2), walk("C", 150, 3, start="2021-01-01"))
    asof = "2021-05-20"
    models, report = train_report(bars, asof)
    rows = {r["symbol"]: r for r in report.collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["n_test"] == 90 and 0 <= rows["A"]["metrics"]["accuracy"] <= 1
    text = {r["symbol"]: r["report"] for r in report_json(report).collect()}
    assert text["A"].startswith('{"metrics":{"accuracy":') and '"model_path":"models/symbol=A"' in text["A"]
    scores = {r["symbol"]: r for r in score_latest(bars, models, asof).collect()}
    assert scores["C"]["status"] == "no_model" and scores["C"]["prob_up"] == 0.5
    assert scores["A"]["status"] == "ok" and scores["A"]["asof"] == "2021-05-20T00:00:00+00:00"
    assert M.check_predictions(score_latest(bars, models, asof)).count() == 0
    late = score_latest(bars, models, "2021-06-30", "2mo")
    assert {r["symbol"]: r["status"] for r in late.collect()}["A"] == "insufficient_history"


def test_cv_report(spark):
    from barsmith.operators.features import labelled_features

    rows = labelled_features(to_spark(spark, walk("A", 300, 1), walk("B", 260, 2)))
    got = M.cv_report(rows, 3).toPandas().sort_values(["symbol", "fold"])
    assert got[["symbol", "fold"]].values.tolist() == [[s, f] for s in "AB" for f in (1, 2, 3)]
    a = got[got["symbol"] == "A"]
    assert a["n_train"].tolist() == [70, 140, 210] and a["n_test"].tolist() == [70, 70, 70]


def test_missing_inputs_count_the_same_in_a_group_and_by_sums(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        x = [float(v) for v in rng.normal(0, 1, len(FEATURES))]
        label = int(x[0] + rng.normal() > 0)
        if i % 10 == 0:
            x[i % len(FEATURES)] = None if i % 20 else float("nan")
        rows.append(("A", *x, None if i % 37 == 0 else label))
    names = ", ".join(f"{f} double" for f in FEATURES)
    frame = spark.createDataFrame([*rows, ("B", *[None] * len(FEATURES), 1)], f"symbol string, {names}, label int")
    used = sum(all(v is not None and v == v for v in r) for r in rows)
    group, sums = (M.train_models(frame, max_rows=n).collect() for n in (1000, 1))
    assert [m["symbol"] for m in group] == [m["symbol"] for m in sums] == ["A"]
    assert group[0]["n_train"] == sums[0]["n_train"] == used and group[0]["status"] == "ok"
    assert np.allclose(group[0]["coef"], sums[0]["coef"], atol=1e-6)


def test_asof_join(spark):
    rows = [("A", d) for d in ("2020-01-05", "2020-02-10", "2020-02-11", "2021-07-01")] + [("B", "2020-03-01"), (None, "2020-03-01"), ("A", None)]
    df = spark.createDataFrame(rows, "symbol string, day string").select("symbol", F.col("day").cast("timestamp_ntz").alias("timestamp"))
    known = [("A", "2020-02-10", 1), ("A", "2020-02-11", 2), ("A", "2020-06-30", 3), ("B", "2020-03-02", 4), (None, "2020-01-01", 5), ("B", None, 6), ("A", "2030-01-01", 7)]
    versions = spark.createDataFrame(known, "symbol string, day string, v int").select("symbol", F.col("day").cast("timestamp_ntz").alias("since"), "v")
    got = {(r.symbol, str(r.timestamp)[:10]): r.v for r in asof_join(df, versions).collect()}
    assert got == {("A", "2020-01-05"): None, ("A", "2020-02-10"): 1, ("A", "2020-02-11"): 2, ("A", "2021-07-01"): 3,
                   ("B", "2020-03-01"): None, (None, "2020-03-01"): None, ("A", "None"): None}
    assert asof_join(df, versions.limit(0)).count() == 7 and asof_join(df.limit(0), versions).count() == 0
    assert {r.symbol: r.v for r in valid_at(versions, "2020-02-10 12:00:00").where("symbol is not null").collect()} == {"A": 1}


def test_kept_versions_and_scores_of_a_past_day(spark, tmp_path):
    path = str(tmp_path / "versions")
    frame = walk("A", 500, 1)
    bars = to_spark(spark, frame)
    for asof in ("2020-12-31", "2021-03-31", "2021-03-31"):
        M.save_version(train_report(bars, asof)[0], path, asof)
    versions = M.load_versions(spark, path)
    assert versions.count() == 2 and M.load_versions(spark, path, "2021-01-01").count() == 1
    early = train_report(bars, "2020-12-31")[0]
    for day in ("2021-01-15", "2021-03-30"):
        assert score_latest(bars, versions, day).collect() == score_latest(bars, early, day).collect()
    assert score_latest(bars, versions, "2020-12-01").first()["status"] == "no_model"
    rows = add_features(bars)
    scored = {r.timestamp: r for r in M.predict_proba_asof(rows, versions).collect()}
    first = {r.timestamp: r.prob_up for r in M.predict_proba(rows, early).collect()}
    for at, row in scored.items():
        expected = None if str(at) < "2020-12-31" else "2020-12-31" if str(at) < "2021-03-31" else "2021-03-31"
        assert (row[M.TRAINED] and str(row[M.TRAINED])[:10]) == expected
        if expected == "2020-12-31":
            assert row.prob_up == first[at]
