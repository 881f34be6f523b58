"""Acceptance gates, the advisory signal, and the contract of every window."""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import RunConfig

@dataclass(frozen=True)
class Rule:
    """A condition of a task's gate: the score at path (from the metrics' root), compared with a limit, or with the score at another path."""

    task: str
    path: str
    compare: str
    limit: float | bool | str

    def holds(self, score: Callable[[str], Any]) -> bool:
        value, limit = score(self.path), score(self.limit) if isinstance(self.limit, str) else self.limit
        return value is not None and limit is not None and bool(COMPARE[self.compare](value, limit))

    def __str__(self) -> str:
        return f"{self.path.replace('weekly_rolling_validation.summary.', 'weekly ')} {self.compare} {self.limit}"


COMPARE: dict[str, Callable[[Any, Any], bool]] = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "is": operator.eq}
_WEEKLY = "weekly_rolling_validation.summary"

# Tasks, scores and limits of the gates.
RULES = (
    Rule("secondary_air_temperature", f"secondary_air_temperature.{_WEEKLY}.fold_count", ">", 0),
    Rule("secondary_air_temperature", f"secondary_air_temperature.{_WEEKLY}.all_folds_model_beats_baseline", "is", True),
    Rule("secondary_air_temperature", f"secondary_air_temperature.{_WEEKLY}.mean_improvement", ">=", 0.10),
    Rule("secondary_air_trend", f"secondary_air_trend.{_WEEKLY}.fold_count", ">", 0),
    Rule("secondary_air_trend", f"secondary_air_trend.{_WEEKLY}.mean_model_macro_f1", ">=", 0.60),
    Rule("kiln_state", f"kiln_state.{_WEEKLY}.fold_count", ">", 0),
    Rule("kiln_state", f"kiln_state.{_WEEKLY}.mean_model_risk_class_recall", ">=", 0.70),
    Rule("fcao", f"fcao_regression.{_WEEKLY}.fold_count", ">", 0),
    Rule("fcao", f"fcao_regression.{_WEEKLY}.all_folds_model_beats_baseline", "is", True),
    Rule("fcao", "fcao_regression.mae", "<", "fcao_regression.persistence_baseline_mae"),
)


def at_path(metrics: Mapping[str, Any], path: str) -> Any:
    """The value at a dotted path of nested mappings; None where it ends early."""
    found: Any = metrics
    for key in path.split("."):
        found = found.get(key) if isinstance(found, Mapping) else None
    return found


def promotion(metrics: Mapping[str, Any], rules: Sequence[Rule] = RULES) -> dict[str, Any]:
    """Which tasks pass all rules of their gate. A direction may be given only if all do; an actuator setting never."""
    of: dict[str, list[Rule]] = {}
    for rule in rules:
        of.setdefault(rule.task, []).append(rule)
    passed = {task: all(rule.holds(lambda path: at_path(metrics, path)) for rule in mine) for task, mine in of.items()}
    tasks = {t: {"passed": ok, "status": "promoted" if ok else "not_promoted", "rule": "; ".join(map(str, of[t]))} for t, ok in passed.items()}
    return tasks | {"objective_direction_allowed": all(passed.values()), "actuator_recommendation_allowed": False}


def gate_column(scores: Mapping[str, Column], rules: Sequence[Rule]) -> Column:
    """Whether all rules hold for the scores of a row, given as a column for each path; a null score fails."""
    ok = F.lit(True)
    for rule in rules:
        limit = scores[rule.limit] if isinstance(rule.limit, str) else F.lit(rule.limit)
        ok = ok & F.coalesce(COMPARE[rule.compare](scores[rule.path], limit), F.lit(False))
    return ok


def direction(predicted: float, target: float, deadband: float, promoted: bool) -> str | None:
    """raise, lower or hold; None unless promoted."""
    if not promoted:
        return None
    return "raise" if predicted < target - deadband else "lower" if predicted > target + deadband else "hold"


def direction_column(predicted: Column, target: float, deadband: float, promoted: Column) -> Column:
    said = F.when(predicted < target - deadband, "raise").when(predicted > target + deadband, "lower").when(predicted.isNotNull(), "hold")
    return F.when(promoted, said)


def direction_signal(predicted: float, target: float, deadband: float, promoted: bool) -> dict[str, Any]:
    return {"objective_direction": direction(predicted, target, deadband, promoted), "actuator_recommendation": None}


def compare_folds(before: DataFrame, after: DataFrame) -> DataFrame:
    """Folds (fold, test_week, model, baseline) of two runs side by side; a side without the fold is null."""
    side = lambda df, s: df.select("fold", *[F.col(c).alias(f"{c}_{s}") for c in ("test_week", "model", "baseline")])
    return side(before, "before").join(side(after, "after"), "fold", "full_outer").orderBy("fold")


def _span(first: int, last: int | None = None) -> str:
    """Minutes about the prediction time, in words."""
    at = lambda m: "prediction_time" if not m else f"prediction_time{m:+d}m"
    return at(first) if last is None else f"{at(first)} to {at(last)}, both included"


def alignment_contract(cfg: RunConfig, delays: Mapping[str, int]) -> dict[str, Any]:
    """What the features and the target of each task may see, made from the settings: a row of minutes for each task."""
    a, b = cfg.temperature_future_start_minutes, cfg.temperature_future_end_minutes
    c, d = cfg.kiln_state_label_start_minutes, cfg.kiln_state_label_end_minutes
    targets = {
        "secondary_air_temperature": {"minutes": (a, b), "value": "mean", "needs": "a stable, known temperature in every minute"},
        "secondary_air_trend": {"minutes": (a, b), "value": "mean less the mean of the last 10 minutes, beyond a dead band", "needs": "as the temperature"},
        "kiln_state_center_30m": {"minutes": (cfg.kiln_state_horizon_minutes, None), "value": "label", "needs": "that minute's label"},
        "kiln_state_window": {"minutes": (c, d), "value": cfg.kiln_state_window_rule, "needs": "every minute's label", "site_approval": "not_claimed"},
        "fcao_event": {"minutes": (cfg.fcao_prediction_horizon_minutes, None), "value": "one assay change", "needs": "a result observed strictly before the prediction time"},
    }
    features = _span(1 - max(cfg.feature_windows_minutes), 0)
    late = {group: f"{_span(-minutes)} and its history" for group, minutes in delays.items()} | {"lab_release": "observed_prior_only"}
    rows = {task: {k: v for k, v in said.items() if k != "minutes"} | {"target_window": _span(*said["minutes"]), "feature_window": late if task == "fcao_event" else features} for task, said in targets.items()}
    return {"minute_bucket": {"interval": "[bucket_start, bucket_end)", "prediction_time": "bucket_end"}} | rows


