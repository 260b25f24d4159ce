"""Scoring: the next-bar direction of every symbol from its newest bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith.functions.scalar import iso_utc
from barsmith.operators.asof import valid_at
from barsmith.operators.features import add_features
from barsmith.operators.model import TRAINED, predict_proba, with_signal
from barsmith.operators.select import last_period, latest_row
from barsmith.schema import at
from barsmith.session import sized_side


def score_latest(bars: DataFrame, models: DataFrame, asof, period: str = "2mo") -> DataFrame:
    """One row per symbol with recent bars: probability, signal, time and status.

    A symbol without a model, or without enough bars for the features, gets 0.5
    and hold, and `status` says why. Of kept versions (`load_versions`) each symbol's newest one
    trained at `asof` or before is taken, so a past day is scored by what was known then.
    """
    if TRAINED in models.columns:
        models = valid_at(models, asof, since=TRAINED)
    recent = last_period(bars, period, asof)
    newest = latest_row(add_features(recent))
    scored = with_signal(predict_proba(newest, models))
    scored = sized_side(scored.select("symbol", "prob_up", "signal", "status"))
    modelled = models.where(F.col("coef").isNotNull())
    modelled = sized_side(modelled.select("symbol", F.lit(True).alias("_known")))
    unscored = F.when(F.col("_known"), "insufficient_history").otherwise("no_model")
    return (
        recent.select("symbol")
        .distinct()
        .join(scored, "symbol", "left")
        .join(modelled, "symbol", "left")
        .select(
            "symbol",
            F.coalesce("prob_up", F.lit(0.5)).alias("prob_up"),
            F.coalesce("signal", F.lit("hold")).alias("signal"),
            iso_utc(at(bars, asof)).alias("asof"),
            F.coalesce("status", unscored).alias("status"),
        )
    )
