"""Per-symbol logistic regression: train, predict, evaluate, cross-validate.

The objective is  ½‖w‖² + Σ log-loss  with a free intercept and no scaling. It is
strictly convex but for separable intercepts, so damped Newton steps find its one
minimum whatever the solver. Symbols of moderate size are fitted whole, one group
per symbol. A symbol with more than `max_rows` rows never becomes one group: each
Newton step sums its gradient and Hessian with an ordinary aggregation instead.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from barsmith.functions.scalar import signal, sigmoid
from barsmith.operators.asof import asof_join
from barsmith.operators.series import SeriesPlan, series_position
from barsmith.schema import FEATURES, at, model_schema
from barsmith.session import discard, scratch_table, sized_side

# The functions that run in tasks travel with the job; executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# When a kept model was trained: up to that moment it knows the bars.
TRAINED = "trained_asof"
MAX_FIT_ROWS = 200_000
MAX_ITER = 200
TOLERANCE = 1e-8
SIZE = len(FEATURES) + 1  # coefficients, then the intercept
PENALTY = np.array([1.0] * len(FEATURES) + [0.0])


def feature_array(df: DataFrame) -> DataFrame:
    """The model inputs as one array column, in the order models use."""
    return df.withColumn("features", F.array(*FEATURES))


# --- training ---------------------------------------------------------------


def _begin() -> dict:
    """Start of a fit: the point to try next is zero, nothing is accepted yet."""
    zero = [0.0] * SIZE
    return {"beta": zero, "step": zero, "scale": 0.0, "loss": float("inf"), "slope": 0.0,
            "n_iter": 0, "done": False}


def _trial(fit: dict) -> np.ndarray:
    return np.asarray(fit["beta"]) + fit["scale"] * np.asarray(fit["step"])


def _advance(fit: dict, loss: float, grad: np.ndarray, hess: np.ndarray) -> dict:
    """Take the log-loss sums at the trial point and choose the next trial."""
    beta = _trial(fit)
    loss = loss + 0.5 * float(np.sum(PENALTY * beta**2))
    grad = grad + PENALTY * beta
    # Equal up to rounding counts as no worse, else the last step never settles.
    ceiling = fit["loss"] + 1e-4 * fit["scale"] * fit["slope"] + 1e-12 * abs(loss)
    if not loss <= ceiling and fit["scale"] > 1e-10:
        return {**fit, "scale": fit["scale"] / 2, "n_iter": fit["n_iter"] + 1}
    done = bool(np.max(np.abs(grad)) <= TOLERANCE * max(1.0, loss)) or 0 < fit["scale"] <= 1e-10
    step = np.linalg.lstsq(hess + np.diag(PENALTY), -grad, rcond=None)[0]
    return {"beta": beta.tolist(), "step": step.tolist(), "scale": 1.0, "loss": loss,
            "slope": float(grad @ step), "n_iter": fit["n_iter"] + 1, "done": done}


def _fit_group(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    x = np.column_stack([rows[FEATURES].to_numpy(float), np.ones(len(rows))])
    y = rows["label"].to_numpy(float)
    fit, status = _begin(), "single_class"
    if 0 < y.sum() < len(y):
        while not fit["done"] and fit["n_iter"] < MAX_ITER:
            z = x @ _trial(fit)
            p = 0.5 * (1.0 + np.tanh(0.5 * z))
            loss = float(np.sum(np.logaddexp(0.0, z) - y * z))
            fit = _advance(fit, loss, x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x)
        status = "ok" if fit["done"] else "not_converged"
    return pd.DataFrame([{**rows[keys].iloc[0].to_dict(), **_model(fit, len(rows), status)}])


def _model(fit: dict, n_train: int, status: str) -> dict:
    known = status != "single_class"
    return {
        "features": FEATURES,
        "coef": list(fit["beta"][:-1]) if known else None,
        "intercept": float(fit["beta"][-1]) if known else None,
        "n_train": int(n_train),
        "n_iter": int(fit["n_iter"]),
        "status": status,
    }


def train_models(df: DataFrame, keys=("symbol",), max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One model row per key from rows with the feature columns and a 0/1 label.

    Rows with a missing input or label do not count, whatever the size of the key; a
    key without any other row has no model.
    """
    keys = list(keys)
    schema = model_schema(keys, df)
    rows = df.select(*keys, *FEATURES, "label").dropna(subset=[*FEATURES, "label"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        return _fit_group(group, keys)

    side = sized_side(rows.groupBy(*keys).count().where(F.col("count") > max_rows).select(*keys))
    if side.isEmpty():
        return rows.groupBy(*keys).applyInPandas(fit, schema)
    usual = rows.join(side, keys, "left_anti").groupBy(*keys).applyInPandas(fit, schema)
    return usual.unionByName(_train_large(rows.join(side, keys, "left_semi"), keys, schema))


def _train_large(rows: DataFrame, keys: list[str], schema: T.StructType) -> DataFrame:
    """The same fit with one aggregation per Newton step, for all large keys at once."""
    rows = scratch_table(rows, "large-rows")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("label").alias("ups"))
    state_schema = T.StructType(
        [df_field for df_field in rows.select(*keys).schema]
        + [
            T.StructField("n", T.LongType()),
            T.StructField("ups", T.LongType()),
            T.StructField("beta", T.ArrayType(T.DoubleType())),
            T.StructField("step", T.ArrayType(T.DoubleType())),
            T.StructField("scale", T.DoubleType()),
            T.StructField("loss", T.DoubleType()),
            T.StructField("slope", T.DoubleType()),
            T.StructField("n_iter", T.IntegerType()),
            T.StructField("done", T.BooleanType()),
        ]
    )
    fields = state_schema.names

    def begin(batches):
        for batch in batches:
            first = [{**r, **_begin()} for r in batch.to_dict("records")]
            for r in first:
                r["done"] = not 0 < r["ups"] < r["n"]
            yield pd.DataFrame(first, columns=fields)

    def advance(batches):
        for batch in batches:
            moved = []
            for r in batch.to_dict("records"):
                if not r["done"]:
                    hess = np.zeros((SIZE, SIZE))
                    hess[np.triu_indices(SIZE)] = r["hess"]
                    hess = hess + np.triu(hess, 1).T
                    r.update(_advance(r, r["sum_loss"], np.asarray(r["grad"]), hess))
                moved.append({f: r[f] for f in fields})
            yield pd.DataFrame(moved, columns=fields)

    state = scratch_table(sizes.mapInPandas(begin, state_schema), "large-state")
    for _ in range(MAX_ITER):
        if state.where("not done").isEmpty():
            break
        sums = _loss_sums(rows, state.where("not done"), keys)
        before = state
        state = scratch_table(state.join(sums, keys, "left").mapInPandas(advance, state_schema), "large-state")
        discard(before)
    discard(rows)

    def finish(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                mixed = 0 < r["ups"] < r["n"]
                status = "single_class" if not mixed else "ok" if r["done"] else "not_converged"
                out.append({**{k: r[k] for k in keys}, **_model(r, r["n"], status)})
            yield pd.DataFrame(out, columns=schema.names)

    return state.mapInPandas(finish, schema)


def _loss_sums(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Log-loss, gradient and upper Hessian at each key's trial point."""
    trial = F.zip_with("beta", "step", lambda b, s: b + F.col("scale") * s)
    side = state.select(*keys, trial.alias("_at"))
    inputs = [*[F.col(c) for c in FEATURES], F.lit(1.0)]
    z, p = F.col("_z"), F.col("_p")
    scored = (
        rows.join(side, keys)
        .withColumn("_z", _dot([F.get("_at", i) for i in range(SIZE)], inputs))
        .withColumn("_p", sigmoid(z))
    )
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("label") * z
    grad = [F.sum((p - F.col("label")) * x) for x in inputs]
    hess = [
        F.sum(p * (1 - p) * inputs[i] * inputs[j]) for i in range(SIZE) for j in range(i, SIZE)
    ]
    return scored.groupBy(*keys).agg(
        F.sum(loss).alias("sum_loss"), F.array(*grad).alias("grad"), F.array(*hess).alias("hess")
    )


def _dot(left: list[Column], right: list[Column]) -> Column:
    total = left[0] * right[0]
    for a, b in zip(left[1:], right[1:]):
        total = total + a * b
    return total


# --- scoring ----------------------------------------------------------------


def predict_proba(df: DataFrame, models: DataFrame, keys=("symbol",)) -> DataFrame:
    """Add `prob_up`; NULL where there is no model. No Python in the row path."""
    usable = models.where(F.col("coef").isNotNull()).select(*keys, "coef", "intercept")
    coef = [F.get("coef", i) for i in range(len(FEATURES))]
    z = F.col("intercept") + _dot(coef, [F.col(c) for c in FEATURES])
    return df.join(sized_side(usable), list(keys), "left").select(
        *df.columns, sigmoid(z).alias("prob_up")
    )


def predict_class(df: DataFrame, models: DataFrame, keys=("symbol",)) -> DataFrame:
    """Add `prob_up` and the predicted label: 1 above one half."""
    scored = predict_proba(df, models, keys)
    return scored.withColumn("predicted", (F.col("prob_up") > 0.5).cast("int"))


def with_signal(scored: DataFrame) -> DataFrame:
    """Fill in 0.5 and hold where no model scored the row, and say so in `status`."""
    status = F.when(F.col("prob_up").isNull(), "no_model").otherwise("ok")
    return scored.withColumns(
        {"status": status, "prob_up": F.coalesce("prob_up", F.lit(0.5))}
    ).withColumn("signal", signal(F.col("prob_up")))


def metrics(scored: DataFrame, keys=("symbol",)) -> DataFrame:
    """Accuracy and F1 of the up class, 0 where F1 is undefined."""
    hit = (F.col("predicted") == F.col("label")).cast("double")
    up, said = F.col("label") == 1, F.col("predicted") == 1
    double_tp = 2 * F.count_if(up & said)
    wrong = F.count_if(up != said)
    return scored.where(F.col("predicted").isNotNull()).groupBy(*keys).agg(
        F.avg(hit).alias("accuracy"),
        F.coalesce(F.try_divide(double_tp, double_tp + wrong), F.lit(0.0)).alias("f1"),
        F.count("*").alias("n_test"),
    )


def evaluate(df: DataFrame, models: DataFrame, keys=("symbol",)) -> DataFrame:
    return metrics(predict_class(df, models, keys), keys)


def check_predictions(df: DataFrame) -> DataFrame:
    """Rows that break the contract of a prediction; none are expected."""
    p, s = F.col("prob_up"), F.col("signal")
    fine = p.between(0.0, 1.0) & s.isin("buy", "sell", "hold")
    return df.where(~F.coalesce(fine, F.lit(False)))


# --- model table ------------------------------------------------------------


def save_models(models: DataFrame, path: str) -> None:
    """One folder per symbol, `symbol=...` below the path."""
    models.write.mode("overwrite").partitionBy("symbol").parquet(path)


def load_models(spark, path: str) -> DataFrame:
    """The saved models; symbols are text even if they look like numbers."""
    stored = spark.read.parquet(path).drop("symbol").schema
    schema = T.StructType([*stored.fields, T.StructField("symbol", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def save_version(models: DataFrame, path: str, asof) -> None:
    """Keep models beside those trained before; ones trained at the same moment are replaced.

    One folder a training, so that their number does not grow with the symbols.
    """
    stamped = models.withColumn(TRAINED, F.date_format(F.lit(asof).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(TRAINED)
        .parquet(path)
    )


def load_versions(spark, path: str, upto=None) -> DataFrame:
    """All kept models with the moment of their training, `trained_asof`; those up to a moment if it is given."""
    stored = spark.read.parquet(path).drop(TRAINED).schema
    schema = T.StructType([*stored.fields, T.StructField(TRAINED, T.TimestampNTZType())])
    versions = spark.read.schema(schema).parquet(path)
    return versions if upto is None else versions.where(F.col(TRAINED) <= at(versions, upto, TRAINED))


def predict_proba_asof(df: DataFrame, versions: DataFrame, keys=("symbol",)) -> DataFrame:
    """`predict_proba` of each row by the model that was known at its time, and when that was trained."""
    usable = versions.where(F.col("coef").isNotNull()).select(*keys, TRAINED, "coef", "intercept")
    coef = [F.get("coef", i) for i in range(len(FEATURES))]
    z = F.col("intercept") + _dot(coef, [F.col(c) for c in FEATURES])
    return asof_join(df, usable, keys, TRAINED).select(*df.columns, TRAINED, sigmoid(z).alias("prob_up"))


# --- temporal cross-validation ----------------------------------------------


def cv_folds(df: DataFrame, folds: int = 5, plan: SeriesPlan | None = None) -> DataFrame:
    """Add `tile`, 1 to folds + 1: equal runs of each symbol's bars by time."""
    tiles = folds + 1
    size, larger = F.floor(F.col("length") / tiles), F.col("length") % tiles
    # The first `larger` tiles hold one bar more.
    in_larger = larger * (size + 1)
    tile = F.when(F.col("position") < in_larger, F.floor(F.col("position") / (size + 1)))
    tile = tile.otherwise(larger + F.floor(F.try_divide(F.col("position") - in_larger, size)))
    placed = series_position(df, plan)
    return placed.select(*df.columns, (tile + 1).cast("int").alias("tile"))


def cv_report(df: DataFrame, folds: int = 5, plan: SeriesPlan | None = None) -> DataFrame:
    """Metrics per symbol and fold; fold j trains on tiles up to j, tests on j + 1."""
    tiled = scratch_table(cv_folds(df, folds, plan), "cv")
    fold = F.explode(F.sequence(F.col("tile"), F.lit(folds)))
    train = tiled.where(F.col("tile") <= folds).select("symbol", *FEATURES, "label", fold.alias("fold"))
    test = tiled.where("tile > 1").withColumn("fold", F.col("tile") - 1)
    keys = ["symbol", "fold"]
    models = scratch_table(train_models(train, keys), "cv-models")
    scores = evaluate(test, models, keys)
    return models.select(*keys, "n_train", "status").join(scores, keys, "left")
