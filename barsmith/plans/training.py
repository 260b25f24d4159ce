"""Training: stored bars to models and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith.operators.features import labelled_features
from barsmith.operators.model import evaluate, save_models, save_version, train_models
from barsmith.operators.select import last_months, min_history, require_both_splits, time_split
from barsmith.operators.series import plan_series
from barsmith.session import scratch_table


def training_rows(
    bars: DataFrame, asof, months: int = 12, min_rows: int = 200, days: int = 90
) -> DataFrame:
    """Labelled feature rows of recent bars, split by time into train and test.

    The rows are written once: the split, the check of both sides, the fits and
    the metrics all read that table instead of repeating the windows.
    """
    recent = min_history(last_months(bars, asof, months), min_rows)
    labelled = scratch_table(labelled_features(recent, plan_series(recent)), "labelled")
    return require_both_splits(time_split(labelled, days))


def train_report(
    bars: DataFrame,
    asof,
    months: int = 12,
    min_rows: int = 200,
    days: int = 90,
    model_path: str = "models",
) -> tuple[DataFrame, DataFrame]:
    """Models, and one report row per symbol with its hold-out metrics."""
    rows = training_rows(bars, asof, months, min_rows, days)
    models = scratch_table(train_models(rows.where("split = 'train'")), "models")
    scores = evaluate(rows.where("split = 'test'"), models)
    fitted = models.select("symbol", "n_train", "status")
    report = fitted.join(scores, "symbol", "left").select(
        "symbol",
        F.struct("accuracy", "f1").alias("metrics"),
        F.concat(F.lit(f"{model_path}/symbol="), "symbol").alias("model_path"),
        "n_train",
        "n_test",
        "status",
    )
    return models, report


def train_run(
    bars: DataFrame, asof, model_path: str, symbols: list[str] | None = None, dry_run: bool = False, **options
) -> DataFrame:
    """Train, save the models where the report says, and return the report.

    Beside the models go the versions of all trainings (`...-versions`) and the report
    (`...-report`), a JSON object a line, one symbol each. `symbols` limits the universe. With
    `dry_run` nothing is saved.
    """
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(symbols))
    models, report = train_report(bars, asof, model_path=model_path, **options)
    if dry_run:
        return report
    report = scratch_table(report, "report")
    save_models(models, model_path)
    save_version(models, f"{model_path.rstrip('/')}-versions", asof)
    lines = F.to_json(F.create_map("symbol", F.struct("metrics", "model_path")), {"ignoreNullFields": "false"})
    report.select(lines.alias("value")).write.mode("overwrite").text(f"{model_path.rstrip('/')}-report")
    return report


def report_json(report: DataFrame) -> DataFrame:
    """One JSON document per symbol, so the report can be any size."""
    entry = F.to_json(F.struct("metrics", "model_path"), {"ignoreNullFields": "false"})
    return report.select("symbol", entry.alias("report"))
