"""The whole run: minutes, clusters, features, forecasts, assay events, gates, signal and report."""

from __future__ import annotations

import argparse
import json
import time as clock
from collections.abc import Sequence
from datetime import datetime, timedelta
from pathlib import Path
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import classification_scores, regression_scores
from ..operators import events as ev
from ..operators import models as mo
from ..operators import splits as sp
from ..operators import timebase as tb
from ..operators import windows as wi
from ..sources import io
from ..spec import KILN, RunConfig, SeriesSpec
from . import audit, gates, report, validation

TIME = "prediction_time"
CLASSES = (0, 1, 2)
TREND_NAMES, STATE_NAMES = {0: "falling", 1: "steady", 2: "rising"}, {0: "bad", 1: "middling", 2: "good"}
TAIL_ROWS = 2_000
LEAST_EVENTS = 20


def chemistry_events(minute: DataFrame, spec: SeriesSpec, before: datetime) -> DataFrame:
    """Changes of the forward-filled chemistry before a time, with its time."""
    filled = tb.forward_fill_chunked(minute.select(TIME, *[F.col(f"`{c}`") for c in spec.chemistry]), spec.chemistry, TIME)
    return ev.vector_changes(filled, spec.chemistry, TIME).where(F.col(TIME) < F.lit(before))


class FeatureStore:
    """Backward features once for all folds; only the two cluster columns are fitted anew for a cutoff."""

    def __init__(self, minute: DataFrame, spec: SeriesSpec, cfg: RunConfig):
        self.minute, self.spec, self.cfg = minute, spec, cfg
        make = lambda rows, by: wi.backward_features(rows, spec.process, cfg.feature_windows_minutes, TIME, by, ["__own"])
        self.plain = wi.chunked(minute, make, before=max(cfg.feature_windows_minutes), order=TIME).persist(StorageLevel.MEMORY_AND_DISK)
        chemistry = minute.select(TIME, *[F.col(f"`{c}`") for c in spec.chemistry])
        self.filled = tb.forward_fill_chunked(chemistry, spec.chemistry, TIME).persist(StorageLevel.MEMORY_AND_DISK)
        self.columns = [c for c in self.plain.columns if c != TIME] + list(wi.CLUSTER_COLUMNS)
        self.clusters: dict[datetime, mo.Clusters] = {}
        self.at = validation.remembered(self._at)

    def fit(self, cutoff: datetime) -> mo.Clusters:
        if cutoff not in self.clusters:
            found = chemistry_events(self.minute, self.spec, cutoff)
            self.clusters[cutoff] = mo.fit_clusters(found, self.spec.chemistry, self.cfg.cluster_k_min, self.cfg.cluster_k_max, self.cfg.random_seed, self.cfg.cluster_restarts, TIME)
        return self.clusters[cutoff]

    def _at(self, cutoff: datetime) -> tuple[DataFrame, Sequence[str], dict]:
        clusters = self.fit(cutoff)
        # the features are kept once; a cutoff only adds two columns to the plan
        placed = clusters.place(self.filled, TIME, wi.CLUSTER_COLUMNS)
        return self.plain.join(placed, TIME), self.columns, {"cluster_fit": clusters.meta | {"fit_end": str(cutoff)}}

    def profile(self, cutoff: datetime) -> DataFrame:
        """Mean raw chemistry of each cluster at the events it was fitted on."""
        which, _ = self.fit(cutoff).columns()
        seen = chemistry_events(self.minute, self.spec, cutoff).select(TIME, which.alias("material_cluster"))
        return mo.cluster_means(seen.join(self.minute, TIME), "material_cluster", (*self.spec.chemistry, *self.spec.chemistry_ratios))


def targets(minute: DataFrame, spec: SeriesSpec, cfg: RunConfig) -> DataFrame:
    """Every forward target, its baseline and whether the row may be used, in one frame."""
    a, b = cfg.temperature_future_start_minutes, cfg.temperature_future_end_minutes
    c, d = cfg.kiln_state_label_start_minutes, cfg.kiln_state_label_end_minutes
    temp, stable = F.col(f"`{spec.temperature}`"), tb.is_stable(spec.stable_above)

    def make(rows: DataFrame, by: list[str]) -> DataFrame:
        rows = rows.withColumns({"future_temp": wi.future_aggregate(temp, a, b, "mean", TIME, by), "recent_temp": wi.trailing(temp, "mean", 10, TIME, by, least=5)})
        return rows.withColumns({
            "trend": wi.deadband_label(F.col("future_temp") - F.col("recent_temp"), cfg.temperature_trend_deadband_c),
            "valid_temp": F.col("stable") & wi.future_all(F.col("stable"), a, b, TIME, by) & F.col("future_temp").isNotNull() & F.col("recent_temp").isNotNull(),
            "state_worst": wi.future_worst(F.col("state"), c, d, cfg.kiln_state_window_rule, TIME, by).cast("int"),
            "state_centre": wi.future_value(F.col("state"), cfg.kiln_state_horizon_minutes, TIME, by),
        })

    known = tb.forward_fill_chunked(minute.withColumn("__grade", F.col(f"`{spec.grade}`")), ["__grade"], TIME)
    rows = known.withColumns({"stable": stable, "state": wi.grade_class(F.col("__grade"))})
    rows = wi.chunked(rows, make, before=10, after=max(b, d, cfg.kiln_state_horizon_minutes), order=TIME)
    return rows.select(TIME, "stable", "state", "future_temp", "recent_temp", "trend", "valid_temp", "state_worst", "state_centre", F.col(f"`{spec.assay}`").alias("assay"))


def _split_summary(rows: DataFrame, target: str, purge: int, stride: int, categorical: bool) -> dict:
    part = lambda p: rows.where(F.col("part") == p)
    return {"purge_minutes": purge} | {p: sp.sample_summary(part(p), target, stride if p == "train" else 1, categorical, TIME) for p in sp.PARTS}


def classify(rows: DataFrame, features: validation.Features, cutoff: datetime, target: str, purge: int, stride: int, weeks: int, baseline: str | None = None, risk: int | None = None) -> tuple[dict, mo.Fitted]:
    """A classifier on a purged split with its weekly validation."""
    usable = rows.where(F.col(target).isNotNull() & (F.col(baseline).isNotNull() if baseline else F.lit(True)))
    parts = sp.purged_split(usable.select(TIME, target, *([baseline] if baseline else [])), purge, TIME).persist()
    sp.check_split(parts, purge, TIME)
    x, columns, _ = features(cutoff)
    train = wi.every(parts.where("part = 'train'"), stride, TIME)
    model = mo.softmax(train.join(x, TIME), columns, target)
    said = model.predict(parts.where("part = 'test'").join(x, TIME), [target, *([baseline] if baseline else [])])
    scores = classification_scores(said, target, "predicted", CLASSES, risk) | {"primary_split": _split_summary(parts, target, purge, stride, True)}
    if baseline:
        scores["persistence_baseline_macro_f1"] = classification_scores(said, target, baseline, CLASSES, risk)["macro_f1"]
    scores["weekly_rolling_validation"] = validation.weekly_classification(usable, features, target, purge, stride, weeks, CLASSES, baseline, risk, TIME)
    parts.unpersist()
    return scores, model


def regress(rows: DataFrame, features: validation.Features, cutoff: datetime, target: str, baseline: str, purge: int, stride: int, alpha: float, weeks: int) -> tuple[dict, mo.Fitted, DataFrame]:
    """Ridge on a purged split, against a baseline column, with its weekly validation and its test predictions."""
    usable = rows.where(F.col(target).isNotNull() & F.col(baseline).isNotNull())
    parts = sp.purged_split(usable.select(TIME, target, baseline), purge, TIME).persist()
    sp.check_split(parts, purge, TIME)
    x, columns, _ = features(cutoff)
    model = mo.ridge(wi.every(parts.where("part = 'train'"), stride, TIME).join(x, TIME), columns, target, alpha)
    said = model.predict(parts.where("part = 'test'").join(x, TIME), [TIME, target, baseline]).persist()
    scores = regression_scores(said, target, "predicted").first().asDict()
    scores["persistence_baseline_mae"] = regression_scores(said, target, baseline).first()["mae"]
    scores["primary_split"] = _split_summary(parts, target, purge, stride, False)
    scores["weekly_rolling_validation"] = validation.weekly_regression(usable, features, target, baseline, purge, stride, alpha, weeks, TIME)
    return scores, model, said


def series_models(store: FeatureStore, cutoff: datetime, spec: SeriesSpec, cfg: RunConfig) -> tuple[dict, dict, DataFrame]:
    """The four forecasts of the minute series: temperature, its trend, and the state at worst and at the centre."""
    rows = targets(store.minute, spec, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    stride, weeks, end = cfg.train_stride_minutes, cfg.weekly_min_train_weeks, cfg.temperature_future_end_minutes
    valid = rows.where("valid_temp")
    scores, fitted = {}, {}
    scores["secondary_air_temperature"], fitted["temp"], said = regress(valid, store.at, cutoff, "future_temp", "recent_temp", end, stride, 20.0, weeks)
    scores["secondary_air_trend"], fitted["trend"] = classify(valid, store.at, cutoff, "trend", end, stride, weeks)
    steady = rows.where("stable")
    scores["kiln_state"], fitted["kiln"] = classify(steady, store.at, cutoff, "state_worst", cfg.kiln_state_label_end_minutes, stride, weeks, "state", 0)
    scores["kiln_state_center"], fitted["kiln_center"] = classify(steady, store.at, cutoff, "state_centre", cfg.kiln_state_horizon_minutes, stride, weeks, "state", 0)
    return scores, fitted, said.orderBy(F.desc(TIME)).limit(TAIL_ROWS).orderBy(TIME)


def assay_models(store: FeatureStore, cutoff: datetime, spec: SeriesSpec, cfg: RunConfig) -> tuple[dict, dict, DataFrame]:
    """Forecasts of the sparse assay from delayed feature groups and the last result that was known.

    Training rows end a horizon before a cutoff unless event_purge_minutes says otherwise.
    """
    horizon = cfg.fcao_prediction_horizon_minutes
    purge = horizon if cfg.event_purge_minutes is None else cfg.event_purge_minutes
    table = ev.event_table(store.minute, spec.assay, horizon).persist(StorageLevel.MEMORY_AND_DISK)
    timing = ev.event_timing(table)
    if timing["events"] != timing["distinct_prediction_times"]:
        raise ValueError("two events share a prediction time")
    delta = F.col("fcao") - F.col("immediate_previous_fcao")
    table = table.withColumns({"delta_fcao": delta, "trend": wi.deadband_label(delta, cfg.fcao_trend_deadband, null_is_steady=True)})
    known = table.where(F.col("previous_fcao_available_at_prediction_time") & F.col("previous_fcao").isNotNull()).persist()
    n = known.count()
    if n < LEAST_EVENTS:
        raise ValueError(f"{n} events with a known previous result are too few")
    candidates = mo.delay_candidates(cfg.fcao_delay_candidates_minutes, spec.delay_candidates)
    chosen: dict[datetime, dict] = {}

    def at(when: datetime) -> tuple[DataFrame, Sequence[str], dict]:
        x, columns, fitted = store.at(when)
        train = known.where(F.col(TIME) < F.lit(when - timedelta(minutes=purge)))
        delays, evidence = mo.select_delays(x, train, candidates, spec.delay_groups, columns)
        chosen[when] = delays
        late = ev.delayed_features(x, known, delays, spec.delay_groups, columns).join(known.select(TIME, F.col("previous_fcao").alias("previous_fcao_input")), TIME)
        names = [*columns, "previous_fcao"]
        wi.check_features(names, spec, {"previous_fcao"})
        # a row for each event: small, and read by several fits
        return late.withColumnRenamed("previous_fcao_input", "previous_fcao").persist(), names, fitted | {"delay_selection": evidence}

    features = validation.remembered(at)
    first = sp.boundaries(known, TIME)[0]
    rows = known.select(TIME, "fcao", F.col("previous_fcao").alias("persisted"), "trend")
    scores = {}
    scores["fcao_regression"], reg, _ = regress(rows, features, first, "fcao", "persisted", purge, 1, 10.0, cfg.weekly_min_train_weeks)
    scores["fcao_trend"], trend = classify(rows, features, first, "trend", purge, 1, cfg.weekly_min_train_weeks)
    scores["fcao_regression"] |= {"event_samples": n, "group_delays_minutes": chosen[first], "time_alignment": timing, "prediction_horizon_minutes": horizon}
    return scores, {"reg": reg, "trend": trend, "delays": chosen[first]}, table


def latest_signal(store: FeatureStore, cutoff: datetime, fitted: dict, assay: dict, spec: SeriesSpec, cfg: RunConfig, status: dict) -> dict[str, Any]:
    """What the models say of the last stable minute: advice at most, and none unless every gate is passed."""
    x, columns, _ = store.at(cutoff)
    stable = store.minute.where(tb.is_stable(spec.stable_above)).select(TIME)
    last = x.join(stable, TIME, "left_semi").where(wi.any_known(columns)).orderBy(F.desc(TIME)).limit(1).persist()
    when = last.first()[TIME]
    say = lambda model, rows=last: model.predict(rows, [TIME]).first().asDict()
    named = lambda said, names: {names[int(k)]: v for k, v in said["predicted_probability"].items()}
    temp, trend, worst, centre = (say(fitted[k]) for k in ("temp", "trend", "kiln", "kiln_center"))
    prior = store.minute.where((F.col(TIME) < F.lit(when)) & F.col(f"`{spec.assay}`").isNotNull()).agg(F.max_by(F.col(f"`{spec.assay}`"), TIME)).first()[0]
    if prior is None:
        raise ValueError("no assay result is known before the latest minute")
    late = ev.delayed_features(x, last.select(TIME), assay["delays"], spec.delay_groups, columns).withColumn("previous_fcao", F.lit(float(prior)))
    allowed = status["objective_direction_allowed"]
    return {
        "timestamp": str(when), "mode": "offline_shadow_only", "predicted_temperature_mean": temp["predicted"], "temperature_target": cfg.secondary_air_target_c, "temperature_trend": TREND_NAMES[trend["predicted"]],
        "predicted_state_centre": STATE_NAMES[centre["predicted"]], "predicted_state_worst": STATE_NAMES[worst["predicted"]], "state_probabilities": named(centre, STATE_NAMES), "state_probabilities_worst": named(worst, STATE_NAMES),
        "predicted_assay": say(assay["reg"], late)["predicted"], "assay_trend": TREND_NAMES[say(assay["trend"], late)["predicted"]], "assay_horizon_minutes": cfg.fcao_prediction_horizon_minutes,
        **gates.direction_signal(temp["predicted"], cfg.secondary_air_target_c, cfg.temperature_trend_deadband_c, allowed), "objective_direction_status": "available" if allowed else "blocked_model_not_promoted", "validation_status": status,
    }


def fold_table(spark: SparkSession, metrics: dict, task: str, score: str) -> DataFrame:
    """(fold, test_week, model, baseline) of a task's weekly folds."""
    folds = metrics.get(task, {}).get("weekly_rolling_validation", {}).get("folds", [])
    rows = [(int(f["fold"]), f["test_week"], float(f["model"][score]), float(f["baseline"][score])) for f in folds if "model" in f]
    return spark.createDataFrame(rows, "fold int, test_week string, model double, baseline double")


TASK_SCORES = {"secondary_air_temperature": "mae", "secondary_air_trend": "macro_f1", "kiln_state": "macro_f1", "kiln_state_center": "macro_f1", "fcao_regression": "mae"}


def compare_runs(spark: SparkSession, reference: str | Path, metrics: dict) -> dict[str, Any]:
    path = Path(reference)
    if not path.exists():
        return {"status": "reference_not_found", "reference_path": str(path)}
    before = json.loads(path.read_text(encoding="utf-8"))
    weekly = lambda m, t: m.get(t, {}).get("weekly_rolling_validation", {})
    tasks = {}
    for task, score in TASK_SCORES.items():
        folds = gates.compare_folds(fold_table(spark, before, task, score), fold_table(spark, metrics, task, score)).collect()  # a row for each week
        fitted = {side: {f["fold"]: f.get("fitted") for f in weekly(m, task).get("folds", [])} for side, m in (("before", before), ("after", metrics))}
        tasks[task] = {
            "before_summary": weekly(before, task).get("summary"), "after_summary": weekly(metrics, task).get("summary"),
            "folds": [r.asDict() | {f"fitted_{side}": found.get(r["fold"]) for side, found in fitted.items()} for r in folds],
        }
    return {"status": "complete", "reference_path": str(path), "tasks": tasks}


def run(spark: SparkSession, config: str | Path, spec: SeriesSpec = KILN) -> dict[str, Any]:
    """All of it for one plant's file; returns the metrics and writes every document to the output folder."""
    started = clock.time()
    cfg = io.load_config(config)
    out = io.output_folder(cfg)
    io.assert_output_safe(cfg.data_path, out)
    before = io.source_metadata(spark, cfg.data_path)
    provenance = audit.audit_source(spark, cfg.data_path, spec)
    minute = io.minute_cache(spark, cfg.data_path, str(out), spec, cfg.reuse_minute_cache).persist(StorageLevel.MEMORY_AND_DISK)
    wi.check_gapless(minute, TIME)
    scan, inlet = audit.audit_inlet(minute, spec, cfg.inlet_chemistry_alignment_step_minutes)
    io.write_csv(scan.orderBy("component", "lag_minutes"), out / "inlet_chemistry_alignment_audit.csv")
    cutoff = sp.boundaries(minute, TIME)[0] - timedelta(minutes=max(cfg.temperature_future_end_minutes, cfg.kiln_state_label_end_minutes))
    store = FeatureStore(minute, spec, cfg)
    wi.check_features(store.columns, spec)
    io.write_csv(store.profile(cutoff), out / "material_cluster_profiles.csv")
    contract = {"columns_ordered": store.columns, "forbidden_fields": sorted(spec.forbidden), "delay_groups": spec.delay_groups, "missing_handling": "training median", "prediction_time": "bucket_end"}
    io.write_json(out / "feature_contract.json", contract)
    scores, fitted, tail = series_models(store, cutoff, spec, cfg)
    more, assay, events = assay_models(store, cutoff, spec, cfg)
    metrics = scores | more | {"material_clustering": store.fit(cutoff).meta, "time_alignment_contract": gates.alignment_contract(cfg, assay["delays"]), "inlet_chemistry_alignment_audit": inlet}
    io.write_csv(events, out / "fcao_event_alignment.csv", bom=False)
    io.write_json(out / "fcao_delay_alignment.json", {"selected_delays_minutes": assay["delays"], "time_alignment": more["fcao_regression"]["time_alignment"]})
    if cfg.pre_a2_reference_metrics_path:
        metrics["stage_a2_pre_post_comparison"] = compare_runs(spark, cfg.pre_a2_reference_metrics_path, metrics)
        io.write_json(out / "stage_a2_pre_post_comparison.json", metrics["stage_a2_pre_post_comparison"])
    status = gates.promotion(metrics)
    signal = latest_signal(store, cutoff, fitted, assay, spec, cfg, status)
    for name, model in (fitted | {"fcao_regression": assay["reg"], "fcao_trend": assay["trend"]}).items():
        model.save(spark, str(out / "models" / name))
    store.fit(cutoff).save(spark, str(out / "models" / "material_clusters"))
    io.write_json(out / "models" / "columns.json", {"series": store.columns, "assay": [*store.columns, "previous_fcao"], "delays_minutes": assay["delays"]})
    span = minute.agg(F.count("*").alias("minute_rows"), F.min(TIME).alias("start"), F.max(TIME).alias("end"), F.count_if(tb.is_stable(spec.stable_above)).alias("stable_minutes"), F.count(F.col(f"`{spec.grade}`")).alias("grade_minutes"))
    summary = span.first().asDict() | {"source_file": cfg.data_path, "feature_count": len(store.columns), "material_clusters": store.fit(cutoff).meta["selected_k"], "assay_events": more["fcao_regression"]["event_samples"]}
    io.write_json(out / "metrics.json", metrics)
    io.write_json(out / "latest_shadow_signal.json", signal)
    io.write_csv(tail, out / "predictions_tail.csv")
    report.write_html(out / "report.html", metrics, signal, summary)
    source = io.assert_unchanged(before, io.source_metadata(spark, cfg.data_path)) | {"columns": io.parquet_columns(spark, cfg.data_path)}
    manifest = cfg.run_manifest_path or str(Path(config).resolve().parent / "run_manifest.json")
    report.write_manifest(
        manifest, config, out, started, config_values=cfg, source=source, feature_contract=contract, source_provenance_audit=provenance, promotion_status=status, data_summary=summary,
        cluster_fit=store.fit(cutoff).meta | {"fit_end": str(cutoff)},
    )
    return metrics


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Forecast a plant's minute series from its Parquet history.")
    parser.add_argument("--config", type=Path, required=True)
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tideline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, given.config)


if __name__ == "__main__":
    main()
