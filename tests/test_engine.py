"""The time-series engine: semantics of time, nulls and causality, models against closed forms, and the whole program."""

import dataclasses
import json
import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tideline.functions import metrics as me
from tideline.operators import events as ev
from tideline.operators import models as mo
from tideline.operators import splits as sp
from tideline.operators import timebase as tb
from tideline.operators import windows as wi
from tideline.plans import audit, gates, program, report, validation
from tideline.sources import io
from tideline.spec import KILN, RunConfig, SeriesSpec
from tideline.streaming.minutes import stream_minutes

T0 = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def series(spark, **columns):
    n = len(next(iter(columns.values())))
    names = list(columns)
    rows = [(at(i), *[columns[c][i] for c in names]) for i in range(n)]
    kinds = ["boolean" if any(isinstance(v, bool) for v in columns[c]) else "double" for c in names]
    rows = [tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in r) for r in rows]
    return spark.createDataFrame(rows, "prediction_time timestamp, " + ", ".join(f"`{c}` {k}" for c, k in zip(names, kinds, strict=True)))


def column(df, name, order="prediction_time"):
    return [r[name] for r in df.orderBy(order).collect()]


# --- time base ---


def test_minute_anchors(spark):
    raw = spark.createDataFrame([(T0 + timedelta(seconds=s), float(v), float(v)) for s, v in ((5, 1), (35, 2), (65, 3))], "time timestamp, a double, b double")
    got = tb.minutes(raw, ["a"], ["b"]).orderBy("prediction_time").collect()
    assert [(r.bucket_start, r.bucket_end, r.prediction_time, r.a, r.b) for r in got] == [(at(0), at(1), at(1), 1.5, 2.0), (at(1), at(2), at(2), 3.0, 3.0)]


def test_minutes_do_not_depend_on_input_order_and_keep_last_known(spark):
    rows = [(T0 + timedelta(seconds=5 * i), float(i) if i % 3 else None) for i in range(60)]
    a = tb.minutes(spark.createDataFrame(rows, "time timestamp, x double").withColumn("y", F.col("x")), ["x"], ["y"])
    b = tb.minutes(spark.createDataFrame(rows[::-1], "time timestamp, x double").withColumn("y", F.col("x")), ["x"], ["y"])
    assert a.orderBy("prediction_time").collect() == b.orderBy("prediction_time").collect()
    assert column(a, "y")[0] == 11.0


def test_clean_nulls_what_is_out_of_range(spark):
    df = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), -1.0, 0.0, 5.0, 10.0, 10.1, None)], "x double")
    assert [r.x for r in tb.clean(df, ["x"], {"x": (0.0, 10.0)}).collect()] == [None, None, None, 0.0, 5.0, 10.0, None, None]
    assert [r.x for r in tb.clean(df, ["x"]).collect()][:3] == [None, None, -1.0]


def test_stable_is_strict_and_null_is_not(spark):
    df = series(spark, a=[1.0, 2.0, None], b=[5.0, 5.0, 5.0])
    assert column(df.withColumn("s", tb.is_stable({"a": 1, "b": 4})), "s") == [False, True, False]


def test_contract_of_minutes(spark):
    good = tb.with_anchors(spark.createDataFrame([(at(0),), (at(1),)], "bucket_start timestamp"))
    tb.check_minutes(good)
    with pytest.raises(AssertionError):
        tb.check_minutes(good.withColumn("bucket_end", F.col("bucket_start")))
    with pytest.raises(AssertionError):
        tb.check_minutes(good.unionByName(good))
    with pytest.raises(AssertionError):
        tb.check_minutes(good.drop("bucket_end"))


def test_grid_and_fill(spark):
    df = spark.createDataFrame([(at(0), 1.0), (at(3), None), (at(2000), 5.0)], "prediction_time timestamp, x double")
    grid = tb.complete_grid(df)
    assert grid.count() == 2001
    chunked = column(tb.forward_fill_chunked(grid, ["x"]), "x")
    assert chunked == column(grid.withColumns(tb.forward_fill(["x"])), "x") == [1.0] * 2000 + [5.0]
    assert tb.complete_grid(df.where("false")).count() == 0


# --- windows ---


def test_backward_windows_equal_pandas(spark):
    rng = np.random.default_rng(0)
    v = [None if rng.random() < 0.25 else float(x) for x in rng.normal(size=300).round(3)]
    df = series(spark, x=v)
    s = pd.Series(v, dtype=float)
    for w in (3, 10):
        for name, want in (("mean", s.rolling(w, min_periods=max(3, w // 2)).mean()), ("std", s.rolling(w, min_periods=max(3, w // 2)).std()), ("delta", s - s.shift(w - 1))):
            got = pd.Series(column(df.withColumn("y", wi.trailing(F.col("x"), name, w)), "y"), dtype=float)
            pd.testing.assert_series_equal(got, want, check_names=False)


def test_exact_forward_window(spark):
    df = series(spark, x=list(range(8)))
    got = column(df.withColumn("y", wi.future_aggregate(F.col("x"), 2, 4, "mean")), "y")
    assert got == [3.0, 4.0, 5.0, 6.0, None, None, None, None]
    for bad in ((-1, 2, "mean"), (3, 2, "mean"), (1, 2, "median")):
        with pytest.raises(ValueError):
            wi.future_aggregate(F.col("x"), *bad)
    wi.check_gapless(df)
    with pytest.raises(ValueError):
        wi.check_gapless(df.where("x <> 3"))


def test_future_change_does_not_alter_past_features(spark):
    v = [float(i) for i in range(16)]
    make = lambda x: wi.backward_features(series(spark, x=x), ["x"], [3]).orderBy("prediction_time").collect()
    a, b = make(v), make(v[:10] + [99999.0] + v[11:])
    assert a[:10] == b[:10] and a[10] != b[10]


def test_chunks_equal_one_window(spark):
    df = series(spark, x=[math.sin(i) for i in range(500)])
    f = lambda d, by: d.select(*[c for c in ("__own", "__chunk") if c in d.columns], "prediction_time", wi.trailing(F.col("x"), "mean", 30, by=by).alias("m"), wi.future_aggregate(F.col("x"), 5, 9, "max", by=by).alias("n"))
    want = f(df, []).orderBy("prediction_time").collect()
    got = wi.chunked(df, f, before=30, after=9, chunk_minutes=60).orderBy("prediction_time").collect()
    assert len(got) == 500
    for a, b in zip(got, want, strict=True):
        assert a.n == b.n and (a.m == b.m or abs(a.m - b.m) < 1e-12)


def test_every_minute_valid(spark):
    df = series(spark, ok=[True, True, True, True, False, True, True, True])
    got = column(df.withColumn("y", wi.future_all(F.col("ok"), 2, 4)), "y")
    assert got == [False, False, False, True, False, False, False, False]


def test_labels(spark):
    df = series(spark, d=[-8.0, -7.0, 0.0, 7.0, 8.0, None], g=[0.4, 2.5, 3.5, 1.0, 5.0, None])
    assert column(df.withColumn("y", wi.deadband_label(F.col("d"), 7)), "y") == [0, 1, 1, 1, 2, None]
    assert column(df.withColumn("y", wi.deadband_label(F.col("d"), 7, True)), "y")[-1] == 1
    assert column(df.withColumn("y", wi.grade_class(F.col("g"))), "y") == [None, 0, 2, 0, 2, None]
    assert wi.every(df, 4).count() == 2


def test_feature_contract():
    spec = SeriesSpec(process=("a", "b"), grade="g", assay="f", forbidden=frozenset(("bad",)))
    wi.check_features(["a", "a__mean_10m", "material_cluster"], spec)
    for c in ("bad", "g", "f__mean_10m", "unknown", "a__max_10m", "a__mean_xm"):
        with pytest.raises(AssertionError):
            wi.check_features([c], spec)
    wi.check_features(["previous_fcao"], spec, {"previous_fcao"})
    for c in KILN.forbidden:
        with pytest.raises(AssertionError):
            wi.check_features([c], KILN)
    assert len(KILN.read_columns) == 34 and len(KILN.forbidden) == 23 and len(KILN.process) == 19
    with pytest.raises(KeyError):
        wi.delay_group("unknown", KILN.delay_groups)
    assert {wi.delay_group(c, KILN.delay_groups) for c in KILN.process} == {"outmill_chemistry", "preheater_calciner_kiln", "kiln_head_grate_cooler"}


# --- events ---


def test_change_events(spark):
    df = series(spark, v=[None, 1, 1, 2, 2, None, 2])
    assert [(r.prediction_time, r.v) for r in ev.change_events(df, "v").orderBy("prediction_time").collect()] == [(at(1), 1.0), (at(3), 2.0), (at(6), 2.0)]


def test_previous_result_is_strictly_earlier(spark):
    v = [3.0 if i >= 80 else 2.0 if 10 <= i < 20 else 1.0 for i in range(130)]
    table = ev.event_table(series(spark, a=v), "a", 60).persist()
    row = table.where(F.col("prediction_time") == F.lit(at(20))).first()
    assert row.previous_fcao == 2.0 and row.previous_historian_observation_time == at(10) and row.immediate_previous_result_time == at(20)
    assert row.previous_fcao_age_minutes_at_prediction == 10.0
    timing = ev.event_timing(table)
    assert timing["events"] == 4 and timing["events_without_available_previous_result"] == 3
    assert len(table.columns) == 15


def test_group_delays_read_rows_not_values(spark):
    df = series(spark, **{g: [b + k for k in range(8)] for g, b in (("p", 0.0), ("q", 100.0), ("r", 200.0))}, h=[300.0 + k if k != 6 else None for k in range(8)])
    groups, times = {"one": {"p"}, "two": {"q", "h"}, "three": {"r"}}, df.where(F.col("prediction_time") == F.lit(at(7))).select("prediction_time")
    got = ev.delayed_features(df, times, {"one": 2, "two": 1, "three": 3}, groups, ["p", "q", "r", "h"]).first()
    assert (got.p, got.q, got.r, got.h) == (5.0, 106.0, 204.0, None)
    holed = df.where(F.col("prediction_time") != F.lit(at(6)))
    assert ev.delayed_features(holed, times, {"two": 1}, groups, ["q"]).first().q == 105.0
    two = holed.where(F.col("prediction_time") != F.lit(at(5)))
    assert ev.delayed_features(two, times, {"two": 1}, groups, ["q"]).first().q is None


# --- splits ---


def test_disjoint_purged_split(spark):
    df = series(spark, x=[1.0] * 80)
    got = sp.purged_split(df, 3)
    sp.check_split(got, 3)
    n = {r.part: r["count"] for r in got.groupBy("part").count().collect()}
    assert n == {"train": 80 * 7 // 10 - 3, "validation": 68 - 56 - 3, "test": 12}
    with pytest.raises(IndexError):
        sp.boundaries(df.where("false"))
    with pytest.raises(AssertionError):
        sp.check_split(df.withColumn("part", F.when(F.col("prediction_time") < F.lit(at(50)), "train").otherwise("test")), 3)


def test_split_multiplies_floats(spark):
    df = series(spark, x=[1.0] * 90)
    assert sp.boundaries(df)[0] == at(int(90 * 0.7)) == at(62)


def test_weeks_with_data_only(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (3, 4, 22, 23, 30)], "prediction_time timestamp")
    folds = list(sp.weekly_folds(df, 60, 1))
    assert [f.week for f in folds] == [datetime(2024, 1, 22), datetime(2024, 1, 29)] and [f.number for f in folds] == [1, 2]
    assert folds[0].test(df).count() == 2 and folds[1].train(df).count() == 4


# --- scores and models ---


def test_scores(spark):
    df = series(spark, t=[1.0, 2.0, 4.0, None], p=[1.0, 3.0, 2.0, 5.0], c=[1.0, 1.0, 1.0, 1.0])
    s = me.regression_scores(df, "t", "p").first()
    assert s.n == 3 and s.mae == 1.0 and s.rmse == pytest.approx(math.sqrt(5 / 3)) and s.r2 == pytest.approx(1 - 5 / (14 / 3))
    assert df.agg(me.correlation(F.col("t"), F.col("c")).alias("r")).first().r is None
    assert me.regression_scores(df, "c", "p").first().r2 is None
    c = me.classification_scores(series(spark, t=[0, 0, 1, 1], p=[0, 1, 1, 1]), "t", "p", [0, 1, 2], 0)
    assert c["macro_f1"] == pytest.approx((2 / 3 + 4 / 5) / 3) and c["balanced_accuracy"] == 0.75 and c["risk_class_recall"] == 0.5
    assert me.fisher_interval(0.5, 3) is None and me.fisher_interval(1.0, 30) is None and me.fisher_interval(None, 30) is None
    low, high = me.fisher_interval(0.5, 103)
    assert low < 0.5 < high


def test_ridge_is_the_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.1]
    y = x @ [1.0, -0.5, 3.0] + rng.normal(size=200)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)]
    df = spark.createDataFrame([(None, *r[1:]) if i % 10 == 0 else r for i, r in enumerate(rows)], "a double, b double, c double, y double").withColumn("n", F.lit(None).cast("double"))
    model = mo.ridge(df, ["a", "b", "c", "n"], "y", 10.0)
    assert model.preparation.columns == ("a", "b", "c")
    z = x.copy()
    z[::10, 0] = np.median(np.delete(x[:, 0], np.arange(0, 200, 10)))
    z = (z - z.mean(0)) / z.std(0)
    want = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean()))
    np.testing.assert_allclose(model.model.coefficients.toArray(), want, atol=1e-8)
    assert model.model.intercept == pytest.approx(y.mean())


def test_softmax_has_a_flat_gradient(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 2))
    y = (x[:, 0] + rng.normal(size=150) > 0.5).astype(int) * 2
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double")
    model = mo.softmax(df, ["a", "b"], "y")
    assert model.classes == (0, 2)
    said = model.predict(df, ["a", "b", "y"]).collect()
    p = np.array([r.predicted_probability["2"] for r in said])
    z = (np.array([(r.a, r.b) for r in said]) - x.mean(0)) / x.std(0)
    t = np.array([r.y for r in said]) / 2
    w = np.where(t == 1, 150 / (2 * t.sum()), 150 / (2 * (150 - t.sum())))
    b = model.model.coefficientMatrix.toArray()
    gradient = z.T @ (w * (p - t)) + (b[2] - b[0]) / 2
    assert np.abs(gradient).max() < 1e-2
    assert abs(sum(said[0].predicted_probability.values()) - 1) < 1e-9
    with pytest.raises(ValueError):
        mo.softmax(df.where("y = 0"), ["a", "b"], "y")


def test_clusters_are_fitted_before_the_cutoff(spark):
    chemistry = ["c1", "c2"]
    df = series(spark, c1=[float(i // 2) for i in range(40)], c2=[float(i // 20) * 50 for i in range(40)])
    spec = SeriesSpec(chemistry=tuple(chemistry))
    seen = program.chemistry_events(df, spec, at(30))
    assert seen.agg(F.max("prediction_time")).first()[0] < at(30)
    found = mo.fit_clusters(seen, chemistry, 2, 3, 5, restarts=2)
    which, far = found.columns()
    rows = df.select("prediction_time", which.alias("k"), far.alias("d")).orderBy("prediction_time").collect()
    assert found.meta["selected_k"] == 2 and rows[0].k != rows[39].k and min(r.d for r in rows) >= 0
    with pytest.raises(ValueError):
        mo.fit_clusters(seen.limit(2), chemistry, 2, 3, 5)


def test_delay_selection_uses_only_the_rows_it_is_given(spark):
    n = 400
    rng = np.random.default_rng(3)
    x = rng.normal(size=n).cumsum()
    features = series(spark, x=list(map(float, x)))
    marks = spark.createDataFrame([(at(i), float(x[i - 5]), 0.0) for i in range(20, n, 10)], "prediction_time timestamp, fcao double, previous_fcao double").persist()
    got, evidence = mo.select_delays(features, marks, {"g": [0, 5, 9]}, {"g": {"x"}}, ["x"])
    assert got == {"g": 5} and evidence["selection_test_rows"] == 0
    assert mo.select_delays(features, marks.limit(5), {"g": [7, 9]}, {"g": {"x"}}, ["x"])[0] == {"g": 7}
    assert mo.delay_candidates({"g": [9, 3, 3]}, {"g": (1,), "h": (2,)}) == {"g": [3, 9], "h": [2]}
    for bad in ([], [-1]):
        with pytest.raises(ValueError):
            mo.delay_candidates({"g": bad}, {"g": (1,)})


def test_lag_scan_finds_the_lag(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=300)
    df = series(spark, a=list(map(float, a)), b=[float(a[i - 30]) if i >= 30 else 0.0 for i in range(300)], c=[1.0] * 300)
    scan = audit.lag_scan(df, {"ab": ("a", "b"), "ac": ("a", "c")}, [0, 30, 60])
    best = {r.component: r.lag_minutes for r in audit.peaks(scan).collect()}
    assert best == {"ab": 30}
    row = scan.where("component = 'ab' and lag_minutes = 30").first()
    assert row.pearson_r == pytest.approx(1) and row.spearman_r == pytest.approx(1) and row.overlap_rows == 270


# --- gates, sources, program ---


def weekly(**summary):
    return {"weekly_rolling_validation": {"summary": {"fold_count": 3, **summary}}}


def test_gates():
    metrics = {
        "secondary_air_temperature": weekly(all_folds_model_beats_baseline=True, mean_improvement=0.1), "secondary_air_trend": weekly(mean_model_macro_f1=0.6),
        "kiln_state": weekly(mean_model_risk_class_recall=0.7), "fcao_regression": weekly(all_folds_model_beats_baseline=True) | {"mae": 1.0, "persistence_baseline_mae": 2.0},
    }
    said = gates.promotion(metrics)
    assert said["objective_direction_allowed"] and not said["actuator_recommendation_allowed"]
    metrics["kiln_state"] = weekly(mean_model_risk_class_recall=None)
    assert not gates.promotion(metrics)["objective_direction_allowed"]
    assert gates.direction_signal(1000, 1100, 7, False) == {"objective_direction": None, "actuator_recommendation": None}
    assert [gates.direction(x, 1100, 7, True) for x in (1092, 1093, 1107, 1108)] == ["raise", "hold", "hold", "lower"]


def test_saved_models_predict_alike(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i, None if i % 11 == 0 else float(a), float(b), float(2 * a - b), 2 if a > 0 else 0) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "id long, `a.x` double, b double, y double, c int")
    for name, made in (("ridge", mo.ridge(df, ["a.x", "b"], "y", 2.0)), ("softmax", mo.softmax(df, ["a.x", "b"], "c"))):
        made.save(spark, str(tmp_path / name))
        again = mo.load(spark, str(tmp_path / name))
        assert (again.preparation, again.kind, again.classes) == (made.preparation, made.kind, made.classes)
        want, got = (m.predict(df, ["id"]).orderBy("id").collect() for m in (made, again))
        assert want == got
    clusters = mo.Clusters(mo.prepare(df, ["a.x", "b"], robust=True), ((0.0, 0.5), (1.0, -1.0)), {"selected_k": 2})
    clusters.save(spark, str(tmp_path / "clusters"))
    assert mo.load_clusters(spark, str(tmp_path / "clusters")) == clusters


def test_guards_and_json(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    for bad in (source, source / "out"):
        with pytest.raises(ValueError):
            io.assert_output_safe(source, bad)
    io.assert_output_safe(source, tmp_path / "out")
    assert io.to_jsonable({"a": np.float64("nan"), "b": [np.int64(3), T0], "c": {1: float("inf")}, "d": frozenset("ba")}) == {"a": None, "b": [3, str(T0)], "c": {"1": None}, "d": ["a", "b"]}
    (tmp_path / "f").write_bytes(b"abc")
    before = io.source_metadata(spark, str(tmp_path / "f"))
    assert before["sha256"].startswith("ba7816bf") and io.assert_unchanged(before, io.source_metadata(spark, str(tmp_path / "f")))["unchanged"]
    monkeypatch.setattr(io, "MOST_HASHED", 2)
    assert io.source_metadata(spark, str(tmp_path / "f"))["sha256"].startswith("ba7816bf")
    (tmp_path / "f").write_bytes(b"abd")
    with pytest.raises(RuntimeError):
        io.assert_unchanged(before, io.source_metadata(spark, str(tmp_path / "f")))
    assert io.package_version("pyspark") and io.package_version("no-such-package") is None
    assert "1.5000" in report.metric_cards({"x": 1.5, "y": {}}) and "y" not in report.metric_cards({"y": {}})


def test_source_audit_follows_the_counts(spark, tmp_path):
    path = str(tmp_path / "s.parquet")
    rows = [(1.0, 1.0, "等级 1"), (2.0, 3.0, "x 等级  2 y"), (3.0, None, "等级 4"), (None, 1.0, None), (4.0, 4.0, "none")]
    spark.createDataFrame(rows, "`窑况等级` double, `窑况等级_1` double, `窑况日志` string").write.parquet(path)
    got = audit.audit_source(spark, path, KILN)
    assert got["label_log_comparison"] == {"common_nonnull": 3, "equal": 2, "mismatch": 1} and got["label_copy_comparison"] == {"common_nonnull": 3, "equal": 2, "mismatch": 1}
    assert "2 of 3" in got["interpretation"] and got["forbidden_source_fields_present"] == ["窑况日志", "窑况等级", "窑况等级_1"]
    with pytest.raises(ValueError):
        io.scan(spark, path, ["missing"])


def test_minute_cache_notices_a_new_source(spark, tmp_path):
    spec = SeriesSpec(process=("x",), ranges={"x": (0.0, 10.0)}, grade="g", assay="f")
    make = lambda v: spark.createDataFrame([(at(0), v, 1.0, 2.0)], "time timestamp, x double, g double, f double").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "s"))
    make(1.0)
    get = lambda: io.minute_cache(spark, str(tmp_path / "s"), str(tmp_path), spec).first().x
    assert get() == get() == 1.0
    make(2.0)
    assert get() == 2.0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(T0 + timedelta(seconds=20 * i), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "time timestamp, x double").withColumn("y", F.col("x"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = stream_minutes(stream, ["x"], ["y"]).writeStream.format("memory").queryName("minutes").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.prediction_time: (r.x, r.y) for r in spark.sql("select * from minutes").collect()}
    want = {r.prediction_time: (r.x, r.y) for r in tb.minutes(df, ["x"], ["y"]).collect()}
    assert got and all(want[k] == v for k, v in got.items()) and len(got) >= len(want) - 3


def test_weekly_skips_single_class_weeks(spark):
    df = spark.createDataFrame([(T0 + timedelta(hours=h), float(h % 5), 1 if h < 24 * 8 else h % 2) for h in range(24 * 21)], "prediction_time timestamp, x double, y int")
    got = validation.weekly_classification(df, lambda _: (df.select("prediction_time", "x"), ["x"], {}), "y", 60, 1, 1, [0, 1])
    assert got["summary"]["skipped_fold_count"] == 1 and got["summary"]["fold_count"] == 1 and got["folds"][1]["baseline_name"] == "train_majority"


def test_whole_program(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 3600  # from one calendar week into the next, so that there is a weekly fold
    t = pd.date_range("2024-01-13 12:00", periods=n, freq="1min")
    # a smaller plant: the stable minutes' columns, the temperature and the ratios
    few_columns = (KILN.temperature, *KILN.stable_above, *KILN.chemistry_ratios)
    plant = dataclasses.replace(KILN, process=few_columns, chemistry=KILN.chemistry[:3])
    wave = np.sin(np.arange(n) / 40.0)
    data = {"time": t}
    for i, c in enumerate(KILN.process[:16]):
        low, high = KILN.ranges[c]
        data[c] = low + (high - low) * (0.8 + 0.05 * wave + 0.01 * rng.normal(size=n)) if c in KILN.stable_above else low + (high - low) * (0.5 + 0.1 * np.roll(wave, i) + 0.01 * rng.normal(size=n))
    for i, c in enumerate((*KILN.chemistry, *KILN.chemistry_ratios, *KILN.inlet_ratios)):
        data[c] = np.repeat(rng.normal(size=n // 40 + 1), 40)[:n] + i + (np.arange(n) // 80 % 3) * 5.0
    data[KILN.grade] = np.repeat(rng.integers(1, 6, size=n // 20 + 1), 20)[:n].astype(float)
    data[KILN.assay] = np.repeat(rng.normal(size=n // 30 + 1).round(2), 30)[:n]
    pd.DataFrame(data).to_parquet(tmp_path / "in.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    cfg = {"data_path": "in.parquet", "output_dir": "out", "cluster_k_min": 2, "cluster_k_max": 2, "feature_windows_minutes": [10], "weekly_min_train_weeks": 1, "inlet_chemistry_alignment_step_minutes": 360, "fcao_delay_candidates_minutes": {"outmill_chemistry": [0, 30], "preheater_calciner_kiln": [0], "kiln_head_grate_cooler": [0]}}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    assert RunConfig("a", "b").cluster_restarts == 20
    loaded = io.load_config(tmp_path / "c.json")
    few = dataclasses.replace(loaded, cluster_restarts=1)
    real, io.load_config = io.load_config, lambda _: few
    try:
        metrics = program.run(spark, tmp_path / "c.json", plant)
    finally:
        io.load_config = real
    out = tmp_path / "out"
    assert {"metrics.json", "latest_shadow_signal.json", "report.html", "predictions_tail.csv", "material_cluster_profiles.csv", "fcao_event_alignment.csv", "fcao_delay_alignment.json", "feature_contract.json", "inlet_chemistry_alignment_audit.csv"} <= {p.name for p in out.iterdir()}
    assert metrics["secondary_air_temperature"]["n"] > 0 and set(metrics) >= {"kiln_state", "kiln_state_center", "fcao_regression", "fcao_trend"}
    signal = json.loads((out / "latest_shadow_signal.json").read_text())
    assert signal["actuator_recommendation"] is None and json.loads((tmp_path / "run_manifest.json").read_text())["source"]["before"]["sha256"]
    # weekly folds exist, and each is fitted on what was known before it
    weekly = {task: metrics[task]["weekly_rolling_validation"] for task in ("secondary_air_temperature", "secondary_air_trend", "kiln_state", "kiln_state_center", "fcao_regression", "fcao_trend")}
    for task, found in weekly.items():
        assert [f["test_week"] for f in found["folds"]] == ["2024-01-15"] and found["summary"]["fold_count"] > 0, task
        assert all(f["fitted"]["cluster_fit"]["last_fit_event"] < f["test_week"] for f in found["folds"] if "fitted" in f)
    manifest = json.loads((tmp_path / "run_manifest.json").read_text())
    assert manifest["source"]["unchanged"] and manifest["config_values"]["cluster_k_max"] == 2 and manifest["cluster_fit"]["selected_k"] == 2 and manifest["code"]["plans/program.py"] and manifest["code"]["plants/kiln.json"]
    # saved models serve a new session: columns, clusters and predictions as in the run
    names = json.loads((out / "models" / "columns.json").read_text())
    clusters = mo.load_clusters(spark, str(out / "models" / "material_clusters"))
    assert len(clusters.centres) == 2 and clusters.meta["selected_k"] == 2
    minute = spark.read.parquet(str(next(out.glob("minute_cache-*"))))
    store = program.FeatureStore(minute, plant, few)
    rows = store.plain.join(clusters.place(store.filled, "prediction_time", wi.CLUSTER_COLUMNS), "prediction_time")
    last = pd.read_csv(out / "predictions_tail.csv").tail(3)
    again = mo.load(spark, str(out / "models" / "temp")).predict(rows.select("prediction_time", *[F.col(f"`{c}`") for c in names["series"]]), ["prediction_time"]).toPandas().set_index("prediction_time")
    for _, r in last.iterrows():
        assert again.predicted[pd.Timestamp(r.prediction_time)] == pytest.approx(r.predicted, rel=1e-6)
    compared = program.compare_runs(spark, out / "metrics.json", metrics)
    assert all(t["before_summary"]["fold_count"] == t["after_summary"]["fold_count"] == len(t["folds"]) for t in compared["tasks"].values())
    assert compared["tasks"]["fcao_regression"]["folds"][0]["fitted_after"]["delay_selection"]["selected_delays_minutes"]
    assert compared["status"] == "complete" and program.compare_runs(spark, out / "none.json", metrics)["status"] == "reference_not_found"


def test_cluster_select_fits_all_rows_with_the_default_restarts(spark, tmp_path, monkeypatch):
    from tideline.plans import queries

    rows = [(k, k % 50, float(900 + k % 7)) for k in range(1, 2501)]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    seen = {}

    def watch(events, *a, **k):
        seen.update(n=events.count(), args=k)
        raise KeyError("seen")

    monkeypatch.setattr(queries.mo, "fit_clusters", watch)
    with pytest.raises(KeyError, match="seen"):
        queries.QUERIES["cluster_select"](spark, str(tmp_path))
    assert seen == {"n": 2500, "args": {}}


def test_silhouette_of_one_component_looks_at_no_pairs(spark):
    table = StructType([StructField("id", LongType()), StructField("v", VectorUDT()), StructField("c", IntegerType())])
    rng = np.random.default_rng(3)
    x, c = np.round(rng.normal(size=400), 1), rng.integers(0, 3, 400)
    x[:5], c[0] = 9.0, 7  # equal values, and a cluster of one
    rows = spark.createDataFrame([(i, Vectors.dense(v), int(k)) for i, (v, k) in enumerate(zip(x.tolist(), c.tolist(), strict=True))], table)
    far, worth = np.abs(x[:, None] - x), []
    for i in range(len(x)):
        others = [far[i, (c == k) & (np.arange(len(x)) != i)] for k in (c[i], *set(c.tolist()) - {c[i]})]
        own, other = (others[0].mean(), min(d.mean() for d in others[1:])) if len(others[0]) else (0.0, 0.0)
        worth.append((other - own) / max(own, other) if max(own, other) else 0.0)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().last().executionId() if store.executionsCount() else -1
    assert mo.silhouette(rows, "v", "c") == pytest.approx(np.mean(worth), abs=1e-12)
    runs = store.executionsList()
    plans = [x.physicalPlanDescription() for x in map(runs.apply, range(runs.size())) if x.executionId() > before]
    assert plans and not any("NOT (i#" in p for p in plans)
    flat = spark.createDataFrame([(i, Vectors.dense(0.1), i % 2) for i in range(9)], table)
    assert mo.silhouette(flat, "v", "c") == 0.0 and mo.silhouette(flat.limit(1), "v", "c") is None and mo.silhouette(flat.limit(0), "v", "c") is None
    plane = rows.withColumn("v", F.udf(lambda v: Vectors.dense(v[0], 0.0), VectorUDT())("v"))
    assert mo.silhouette(plane, "v", "c") == pytest.approx(np.mean(worth), abs=1e-12)


def test_cluster_fits_take_equal_events_as_one_weighted_point(spark, monkeypatch):
    rows = [(i, float(10 * (i % 3 == 0) + i % 2), float(-5 * (i % 3 == 0))) for i in range(1200)]
    events, seen = spark.createDataFrame(rows, "prediction_time long, a double, b double"), []

    class Watched(mo.KMeans):
        def fit(self, data):
            seen.append(tuple(data.agg(F.count("*"), F.sum("weight") if "weight" in data.columns else F.lit(0.0)).first()))
            return super().fit(data)

    monkeypatch.setattr(mo, "KMeans", Watched)
    found = mo.fit_clusters(events, ["a", "b"], 2, 2, 7, restarts=2)
    assert seen == [(4, 1200.0)] * 2
    prep, plain = found.preparation, np.array([r[1:] for r in rows])
    plain = (plain - [prep.centre[c] for c in "ab"]) / [prep.scale[c] for c in "ab"]
    first = np.arange(1200) % 3 == 0
    want = sorted(tuple(plain[m].mean(0)) for m in (first, ~first))
    assert np.allclose(sorted(found.centres), want) and found.meta["chemistry_change_events"] == 1200


def plain_silhouette(x, labels):
    """Mean silhouette over all rows, pair by pair."""
    far = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    sums = {k: far[:, labels == k].sum(1) for k in set(labels.tolist())}
    own = np.array([sums[k][i] / max((labels == k).sum() - 1, 1) for i, k in enumerate(labels.tolist())])
    other = np.min([np.where(labels == k, np.inf, sums[k] / (labels == k).sum()) for k in sums], axis=0)
    alone = np.array([(labels == k).sum() == 1 for k in labels.tolist()])
    return np.where(alone, 0.0, (other - own) / np.maximum(own, other)).mean()


def test_cluster_numbers_are_chosen_by_all_events(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(5400, 2)) + 4 * (np.arange(5400) % 3 == 0)[:, None], 1)
    events = spark.createDataFrame([(i, *p) for i, p in enumerate(x.tolist())], "prediction_time long, a double, b double")
    found = mo.fit_clusters(events, ["a", "b"], 2, 3, 7, restarts=2)
    prep = found.preparation
    plain = (x - [prep.centre[c] for c in "ab"]) / [prep.scale[c] for c in "ab"]
    labels = np.array([r.k for r in events.select("prediction_time", found.columns()[0].alias("k")).orderBy("prediction_time").collect()])
    assert found.meta["selected_k"] == 2 and set(found.meta["silhouette_by_k"]) == {"2", "3"}
    assert found.meta["silhouette_by_k"]["2"] == pytest.approx(plain_silhouette(plain, labels), abs=1e-9)


def test_silhouettes_of_weighted_points_are_those_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(mo, "AGAINST", 40)
    monkeypatch.setattr(mo, "PARTS", 3)
    rng = np.random.default_rng(4)
    x, c, e, w = rng.normal(size=(150, 2)), rng.integers(0, 3, 150), rng.integers(0, 2, 150), rng.integers(1, 4, 150)
    c[0], w[0], c[1], w[1] = 7, 1, 8, 3  # clusters of one row, and of one point that stands for three
    table = StructType([StructField("id", LongType()), StructField("v", VectorUDT()), StructField("c", IntegerType()), StructField("e", IntegerType()), StructField("w", LongType())])
    points = spark.createDataFrame([(i, Vectors.dense(x[i]), int(c[i]), int(e[i]), int(w[i])) for i in range(150)], table)
    want = [plain_silhouette(np.repeat(x, w, 0), np.repeat(k, w)) for k in (c, e)]
    assert mo.silhouettes(points, "v", ["c", "e"], "w") == pytest.approx(want, abs=1e-12)
    line = points.withColumn("v", F.udf(lambda v: Vectors.dense(v[0]), VectorUDT())("v"))
    want = [plain_silhouette(np.repeat(x[:, :1], w, 0), np.repeat(k, w)) for k in (c, e)]
    assert mo.silhouettes(line, "v", ["c", "e"], "w") == pytest.approx(want, abs=1e-12)
    unknown = points.withColumn("c", F.when(F.col("id") > 0, F.col("c")))
    assert mo.silhouettes(unknown, "v", ["c"], "w")[0] is not None and mo.silhouettes(points.limit(0), "v", ["c"], "w") == [None]
