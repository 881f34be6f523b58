"""Weekly walk-forward validation: one fit for each week, on what was known a horizon before it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import classification_scores, regression_scores
from ..operators.models import ridge, softmax
from ..operators.splits import sample_summary, weekly_folds
from ..operators.windows import every

#: Given a cutoff: rows with the features fitted before it, their names, and what was fitted.
Features = Callable[[datetime], tuple[DataFrame, Sequence[str], dict]]


def remembered(make: Features) -> Features:
    """make, called once for each cutoff; frames are lazy plans, so what is kept is small."""
    kept: dict[datetime, tuple] = {}

    def get(cutoff: datetime) -> tuple[DataFrame, Sequence[str], dict]:
        if cutoff not in kept:
            kept[cutoff] = make(cutoff)
        return kept[cutoff]

    return get


def _one(df: DataFrame) -> dict:
    return df.first().asDict()


def _mean(values: Sequence[float]) -> float | None:
    return sum(values) / len(values) if values else None


def weekly_regression(rows: DataFrame, features: Features, target: str, baseline: str, horizon: int, stride: int, alpha: float, min_train_weeks: int, time: str = "prediction_time") -> dict[str, Any]:
    """Folds with the scores of ridge and of the baseline, over rows that have target and baseline."""
    usable = rows.where(F.col(target).isNotNull() & F.col(baseline).isNotNull()).select(time, target, baseline).persist(StorageLevel.MEMORY_AND_DISK)
    folds = []
    for fold in weekly_folds(usable, horizon, min_train_weeks, time):
        train, test = fold.train(usable, time), fold.test(usable, time)
        about = sample_summary(train, target, stride, time=time), sample_summary(test, target, time=time)
        if about[0]["rows"] < 2 or not about[1]["rows"]:
            continue
        x, columns, fitted = features(fold.train_before)
        model = ridge(every(train, stride, time).join(x, time), columns, target, alpha)
        said = model.predict(test.join(x, time), [target, baseline])
        scores, base = _one(regression_scores(said, target, "predicted")), _one(regression_scores(said, target, baseline))
        folds.append({"fold": fold.number, "test_week": str(fold.week.date()), "purge_minutes": horizon, "train": about[0], "test": about[1], "baseline": base, "model": scores, "model_beats_baseline": scores["mae"] < base["mae"], "fitted": fitted})
    usable.unpersist()
    return {"folds": folds, "summary": summarise_regression(folds)}


def summarise_regression(folds: Sequence[dict]) -> dict[str, Any]:
    """Means over folds (each with model.mae and baseline.mae), and whether the model is better in all."""
    m, b = [f["model"]["mae"] for f in folds], [f["baseline"]["mae"] for f in folds]
    better = 1 - _mean(m) / _mean(b) if folds and _mean(b) > 0 else None
    return {"fold_count": len(folds), "mean_model_mae": _mean(m), "mean_baseline_mae": _mean(b), "mean_improvement": better, "all_folds_model_beats_baseline": bool(folds) and all(x < y for x, y in zip(m, b, strict=True))}


def weekly_classification(rows: DataFrame, features: Features, target: str, horizon: int, stride: int, min_train_weeks: int, labels: Sequence[int], baseline: str | None = None, risk: int | None = None, time: str = "prediction_time") -> dict[str, Any]:
    """Folds with the scores of the classifier and of persistence (the baseline column) or the strided training majority.

    A week whose training rows have a single class is listed as skipped.
    """
    keep = [time, target, *([baseline] if baseline else [])]
    ok = F.col(target).isNotNull() & (F.col(baseline).isNotNull() if baseline else F.lit(True))
    usable = rows.where(ok).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    folds = []
    for fold in weekly_folds(usable, horizon, min_train_weeks, time):
        train, test = fold.train(usable, time), fold.test(usable, time)
        about = {"train": sample_summary(train, target, stride, True, time), "test": sample_summary(test, target, 1, True, time)}
        if about["train"]["rows"] < 2 or not about["test"]["rows"]:
            continue
        head = {"fold": fold.number, "test_week": str(fold.week.date()), **about}
        fit_rows, seen = every(train, stride, time), majority(train, target, stride, time)
        if seen["n"] < 2:
            folds.append(head | {"status": "skipped_insufficient_train_classes"})
            continue
        x, columns, fitted = features(fold.train_before)
        model = softmax(fit_rows.join(x, time), columns, target)
        said = model.predict(test.join(x, time), keep[1:]).withColumn("base", F.col(baseline) if baseline else F.lit(int(seen["most"])))
        said = said.persist(StorageLevel.MEMORY_AND_DISK)
        scores, base = classification_scores(said, target, "predicted", labels, risk), classification_scores(said, target, "base", labels, risk)
        said.unpersist()
        folds.append(head | {"purge_minutes": horizon, "baseline_name": "persistence" if baseline else "train_majority", "baseline": base, "model": scores, "model_beats_baseline": scores["macro_f1"] > base["macro_f1"], "fitted": fitted})
    usable.unpersist()
    return {"folds": folds, "summary": summarise_classification(folds, risk is not None)}


def summarise_classification(folds: Sequence[dict], risk: bool = False) -> dict[str, Any]:
    """Means over the folds that were fitted, and how many were skipped."""
    done = [f for f in folds if "model" in f]
    f1 = lambda which: [f[which]["macro_f1"] for f in done]
    summary = {"fold_count": len(done), "skipped_fold_count": len(folds) - len(done), "mean_model_macro_f1": _mean(f1("model")), "mean_baseline_macro_f1": _mean(f1("baseline")), "all_folds_model_beats_baseline": bool(done) and all(x > y for x, y in zip(f1("model"), f1("baseline"), strict=True))}
    return summary | ({"mean_model_risk_class_recall": _mean([f["model"]["risk_class_recall"] for f in done])} if risk else {})


def majority(train: DataFrame, target: str, stride: int, time: str = "prediction_time") -> dict:
    """Of the strided training rows: how many classes there are, and the most frequent one, the smallest of equals."""
    return every(train, stride, time).agg(F.countDistinct(target).alias("n"), F.mode(target, True).alias("most")).first().asDict()
