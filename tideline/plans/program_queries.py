"""Registered queries of the whole program's parts: targets, folds, gates, preparation, models and files, with their SQL.

They add to the registry of ``queries`` when imported.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as me
from ..operators import models as mo
from ..operators import splits as sp
from ..operators import timebase as tb
from ..sources import io
from ..spec import RunConfig, SeriesSpec
from . import gates, program, validation
from .queries import _CLASS, _G, _M, _PAIRS, _classes, _persistence, events, query, r, total_minutes

# --- targets --------------------------------------------------------------------------

_TARGETS = f"""
    WITH {_G}, n AS (SELECT date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, 1.0 + count(*) % 5 AS grade FROM events GROUP BY 1),
    f AS (SELECT prediction_time, last_value(value IGNORE NULLS) OVER w AS v, last_value(grade IGNORE NULLS) OVER w AS g FROM s LEFT JOIN n USING (prediction_time) WINDOW w AS (ORDER BY prediction_time ROWS UNBOUNDED PRECEDING)),
    t AS (SELECT prediction_time, v, coalesce(v > 10, false) AS stable, CASE WHEN g IN (1, 2) THEN 0 WHEN g = 3 THEN 1 WHEN g IN (4, 5) THEN 2 END AS state FROM f),
    u AS (
        SELECT prediction_time, stable, state, CASE WHEN count(v) OVER a = 11 THEN avg(v) OVER a END AS future_temp, CASE WHEN count(v) OVER p >= 5 THEN avg(v) OVER p END AS recent_temp,
               count(CASE WHEN stable THEN 1 END) OVER a = 11 AS ahead_stable, CASE WHEN count(state) OVER a = 11 THEN min(state) OVER a END AS state_worst, lead(state, 30) OVER (ORDER BY prediction_time) AS state_centre
        FROM t WINDOW a AS (ORDER BY prediction_time ROWS BETWEEN 25 FOLLOWING AND 35 FOLLOWING), p AS (ORDER BY prediction_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
    )
    SELECT prediction_time, stable, state, round(future_temp, 6) AS future_temp, round(recent_temp, 6) AS recent_temp,
           CASE WHEN future_temp - recent_temp < -7.0005 THEN 0 WHEN future_temp - recent_temp > 7.0005 THEN 2 WHEN future_temp - recent_temp IS NOT NULL THEN 1 END AS trend,
           stable AND ahead_stable AND future_temp IS NOT NULL AND recent_temp IS NOT NULL AS valid_temp, state_worst, state_centre
    FROM u
"""


@query("series_targets", _TARGETS)
def series_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every forward target of the program, over the minute series of events as a plant's temperature and grades."""
    minute = (F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.expr("interval 1 minute")).alias("prediction_time")
    grades = events(spark, sf_dir).groupBy(minute).agg((1.0 + F.count("*") % 5).alias("grade"))
    filled = tb.forward_fill_chunked(tb.complete_grid(total_minutes(spark, sf_dir).select("prediction_time", "value")), ["value"])
    spec = SeriesSpec(temperature="value", grade="grade", assay="assay", stable_above={"value": 10.0})
    rows = filled.join(grades, "prediction_time", "left").withColumn("assay", F.lit(None).cast("double"))
    t = program.targets(rows, spec, RunConfig("", "", temperature_trend_deadband_c=7.0005))
    return t.select("prediction_time", "stable", "state", r(F.col("future_temp")).alias("future_temp"), r(F.col("recent_temp")).alias("recent_temp"), "trend", "valid_temp", "state_worst", "state_centre")


# --- folds and gates ------------------------------------------------------------------

_WEEKS = "w AS (SELECT week, row_number() OVER (ORDER BY week) AS k FROM (SELECT DISTINCT date_trunc('week', prediction_time)::timestamp AS week FROM m))"
_FOLD = f"{_M}, {_WEEKS}, f AS (SELECT k - 2 AS fold, week, week - interval 35 minute AS train_before FROM w WHERE k > 2)"


def _minutes_with_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = total_minutes(spark, sf_dir).select(F.col("prediction_time").cast("timestamp").alias("prediction_time"), "value")
    return rows.withColumn("y", F.when(F.col("value") < 15, 0).when(F.col("value") > 40, 2).otherwise(1))


@query(
    "weekly_folds",
    f"""
    WITH {_FOLD} SELECT fold, strftime(week, '%Y-%m-%d') AS test_week, (SELECT count(*) FROM m WHERE prediction_time < train_before) AS train_rows,
    (SELECT count(*) FROM m WHERE prediction_time >= week AND prediction_time < week + interval 7 day) AS test_rows FROM f
    """,
)
def weekly_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _minutes_with_class(spark, sf_dir).persist()
    found = [(f.number, str(f.week.date()), f.train(rows).count(), f.test(rows).count()) for f in sp.weekly_folds(rows, 35, 2)]
    return spark.createDataFrame(found, "fold long, test_week string, train_rows long, test_rows long")


@query(
    "weekly_majority",
    f"""
    WITH {_FOLD}, y AS (SELECT prediction_time, CASE WHEN value < 15 THEN 0 WHEN value > 40 THEN 2 ELSE 1 END AS y FROM m),
    t AS (SELECT fold, y, row_number() OVER (PARTITION BY fold ORDER BY prediction_time) - 1 AS p FROM f JOIN y ON prediction_time < train_before),
    c AS (SELECT fold, y, count(*) AS n FROM t WHERE p % 5 = 0 GROUP BY 1, 2),
    b AS (SELECT fold, sum(n)::BIGINT AS fit_rows, count(*) AS classes, arg_max(y, n * 10 - y) AS most FROM c GROUP BY 1),
    z AS (SELECT fold, most, count(*) AS n, count(*) FILTER (y = most) AS h FROM f JOIN b USING (fold) JOIN y ON prediction_time >= week AND prediction_time < week + interval 7 day GROUP BY 1, 2)
    SELECT fold, fit_rows, classes, b.most AS majority, round(2.0 * h / (h + n) / 3, 9) AS baseline_macro_f1 FROM b JOIN z USING (fold)
    """,
)
def weekly_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a classifier's weekly folds are held against: the strided training majority and its score on the week."""
    rows, found = _minutes_with_class(spark, sf_dir).persist(), []
    for fold in sp.weekly_folds(rows, 35, 2):
        train = fold.train(rows)
        seen, about = validation.majority(train, "y", 5), sp.sample_summary(train, "y", 5, True)
        base = me.classification_scores(fold.test(rows).withColumn("said", F.lit(int(seen["most"]))), "y", "said", [0, 1, 2])
        found.append((fold.number, about["rows_after_stride"], seen["n"], int(seen["most"]), round(base["macro_f1"], 9)))
    return spark.createDataFrame(found, "fold long, fit_rows long, classes long, majority int, baseline_macro_f1 double")


@query("weekly_classification")
def weekly_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly folds of a classifier of minutes by their value and hour; fitted, so without SQL."""
    rows = _minutes_with_class(spark, sf_dir).persist()
    x = rows.select("prediction_time", "value", F.hour("prediction_time").cast("double").alias("hour"))
    done = validation.weekly_classification(rows, lambda _: (x, ["value", "hour"], {}), "y", 35, 5, 2, [0, 1, 2], risk=0)
    found = [(f["fold"], f["test_week"], f["model"]["macro_f1"], f["baseline"]["macro_f1"], f["model_beats_baseline"]) for f in done["folds"] if "model" in f]
    return spark.createDataFrame(found, "fold int, test_week string, model_macro_f1 double, baseline_macro_f1 double, better boolean")


@query(
    "promotion_gate",
    f"""
    WITH p AS (SELECT user_id, week, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS said FROM (SELECT *, date_trunc('week', ts)::timestamp AS week FROM events)),
    f AS (SELECT user_id, week, avg(abs(value - said)) AS b, avg(abs(value - 30)) AS m FROM p WHERE said IS NOT NULL GROUP BY 1, 2)
    SELECT user_id, count(*) AS folds, coalesce(count(*) > 0 AND bool_and(m < b) AND 1 - avg(m) / avg(b) >= 0.1, false) AS passed FROM f GROUP BY 1
    """,
)
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature's gate, for every user's weekly folds of a constant forecast against persistence."""
    rows = _persistence_by_user(spark, sf_dir)
    folds = rows.groupBy("user_id", "week").agg(F.avg(F.abs(F.col("value") - F.col("said"))).alias("b"), F.avg(F.abs(F.col("value") - 30)).alias("m"))
    weekly = "secondary_air_temperature.weekly_rolling_validation.summary"
    of = folds.groupBy("user_id").agg(F.count("*").alias("folds"), F.bool_and(F.col("m") < F.col("b")).alias("all"), (1 - F.avg("m") / F.avg("b")).alias("better"))
    scores = {f"{weekly}.fold_count": F.col("folds"), f"{weekly}.all_folds_model_beats_baseline": F.col("all"), f"{weekly}.mean_improvement": F.col("better")}
    return of.select("user_id", "folds", gates.gate_column(scores, [x for x in gates.RULES if x.task == "secondary_air_temperature"]).alias("passed"))


def _persistence_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window as W

    rows = events(spark, sf_dir).withColumn("said", F.lag("value").over(W.partitionBy("user_id").orderBy("ts", "event_id")))
    return rows.where("said is not null").select("user_id", sp.week_of("ts").alias("week"), "value", "said")


@query(
    "class_scores",
    f"""
    WITH {_PAIRS}, c AS (SELECT {_CLASS.format('value')} AS t, {_CLASS.format('said')} AS q FROM p WHERE said IS NOT NULL),
    k AS (SELECT t, avg(CASE WHEN q = t THEN 1.0 ELSE 0 END) AS recall FROM c GROUP BY 1)
    SELECT round(avg(recall), 9) AS balanced_accuracy, round(max(CASE WHEN t = 0 THEN recall END), 9) AS risk_class_recall FROM k
    """,
)
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = me.classification_scores(_classes(spark, sf_dir), "t", "p", [0, 1, 2], 0)
    return spark.createDataFrame([(round(s["balanced_accuracy"], 9), round(s["risk_class_recall"], 9))], "balanced_accuracy double, risk_class_recall double")


# --- preparation and models -----------------------------------------------------------


@query(
    "robust_scale",
    """
    WITH q AS (SELECT 'l_quantity' AS name, quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS q FROM lineitem UNION ALL SELECT 'l_extendedprice', quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) FROM lineitem)
    SELECT name, round(q[2], 6) AS median, round(q[2], 6) AS centre, round(CASE WHEN q[3] - q[1] > 1e-12 THEN q[3] - q[1] ELSE 1 END, 6) AS scale FROM q
    """,
)
def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mo.prepare(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_quantity", "l_extendedprice"], robust=True)
    return spark.createDataFrame([(c, round(p.median[c], 6), round(p.centre[c], 6), round(p.scale[c], 6)) for c in p.columns], "name string, median double, centre double, scale double")


_FILLED = "f AS (SELECT p_partkey, coalesce(CASE WHEN p_partkey % 5 > 0 THEN p_size END, (SELECT quantile_cont(p_size, 0.5) FROM part WHERE p_partkey % 5 > 0))::DOUBLE AS x, p_retailprice FROM part)"


@query("z_score", f"WITH {_FILLED} SELECT p_partkey, round((x - (SELECT avg(x) FROM f)) / (SELECT stddev_pop(x) FROM f), 6) AS z FROM f")
def z_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.when(F.col("p_partkey") % 5 > 0, F.col("p_size")).alias("size"))
    return rows.select("p_partkey", r(mo.prepare(rows, ["size"]).column("size")).alias("z"))


@query(
    "ridge_closed_form",
    f"""
    WITH {_PAIRS.replace('SELECT week,', 'SELECT event_id, week,')}, f AS (SELECT event_id, value, coalesce(said, (SELECT quantile_cont(said, 0.5) FROM p)) AS x FROM p),
    a AS (SELECT avg(x) AS c, stddev_pop(x) AS s, avg(value) AS y0, count(*) AS n FROM f), b AS (SELECT sum((x - c) / s * (value - y0)) / max(n + 20.0) AS w FROM f, a)
    SELECT event_id, round(y0 + w * (x - c) / s, 5) AS predicted FROM f, a, b
    """,
)
def ridge_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge of an event's value on the user's last one, for which SQL has the closed form."""
    from pyspark.sql.window import Window as W

    rows = events(spark, sf_dir).select("event_id", "value", F.lag("value").over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("x")).persist()
    return mo.ridge(rows, ["x"], "value", 20.0).predict(rows, ["event_id"]).select("event_id", r(F.col("predicted"), 5).alias("predicted"))


_CENTRES = ((0.0, 0.0), (1.0, 0.5), (-1.0, 0.25), (0.5, -0.75))


def _place_sql() -> str:
    z = "SELECT p_partkey, (x - (SELECT quantile_cont(x, 0.5) FROM f)) / (SELECT quantile_cont(x, 0.75) - quantile_cont(x, 0.25) FROM f) AS a, (p_retailprice - (SELECT quantile_cont(p_retailprice, 0.5) FROM f)) / (SELECT quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25) FROM f) AS b FROM f"
    far = ", ".join(f"sqrt((a - ({p})) ** 2 + (b - ({q})) ** 2)" for p, q in _CENTRES)
    return f"WITH {_FILLED}, z AS ({z}), d AS (SELECT p_partkey, [{far}] AS d FROM z) SELECT p_partkey, (list_position(d, list_min(d)) - 1)::INTEGER AS cluster, round(list_min(d), 6) AS distance FROM d"


@query("cluster_place", _place_sql())
def cluster_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's nearest of given centres, on robustly scaled columns, by clusters that were saved and loaded."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.when(F.col("p_partkey") % 5 > 0, F.col("p_size")).alias("size"), "p_retailprice")
    path = _folder(spark)
    mo.Clusters(mo.prepare(rows, ["size", "p_retailprice"], robust=True), _CENTRES).save(spark, path)
    which, far = mo.load_clusters(spark, path).columns()
    return rows.select("p_partkey", which.alias("cluster"), r(far).alias("distance"))


@query(
    "silhouette",
    """
    WITH s AS (SELECT s_suppkey AS i, s_acctbal AS x, s_nationkey % 3 AS c FROM supplier), d AS (SELECT a.i, a.c, b.c AS o, avg(abs(a.x - b.x)) AS d FROM s a JOIN s b ON a.i <> b.i GROUP BY ALL),
    w AS (SELECT i, min(CASE WHEN c = o THEN d END) AS own, min(CASE WHEN c <> o THEN d END) AS other FROM d GROUP BY 1)
    SELECT round(avg(CASE WHEN own IS NULL OR other IS NULL THEN 0 ELSE coalesce((other - own) / nullif(greatest(own, other), 0), 0) END), 9) AS silhouette FROM w
    """,
)
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("id"), "s_acctbal", (F.col("s_nationkey") % 3).alias("cluster"))
    found = mo.silhouette(VectorAssembler(inputCols=["s_acctbal"], outputCol="v").transform(rows), "v", "cluster")
    return spark.createDataFrame([(None if found is None else round(found, 9),)], "silhouette double")


# --- files ----------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share; where none is set, in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/round-trip-{uuid.uuid4().hex}"


@query(
    "minute_cache",
    """
    SELECT event_type, date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, round(avg(user_id), 6) AS user_id, arg_max(value, ts) AS value
    FROM events GROUP BY 1, date_trunc('minute', ts)
    """,
)
def minute_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute frame of a source as its cache gives it when it is asked again."""
    spec = SeriesSpec(time="ts", process=("user_id",), grade="event_id", assay="value", by=("event_type",))
    folder = _folder(spark)
    io.minute_cache(spark, f"{sf_dir}/events.parquet", folder, spec)
    again = io.minute_cache(spark, f"{sf_dir}/events.parquet", folder, spec)
    return again.select("event_type", F.col("prediction_time").cast("timestamp_ntz").alias("prediction_time"), r(F.col("user_id")).alias("user_id"), "value")


@query("csv_round_trip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = io.scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    path = _folder(spark)
    io.write_csv_files(rows, path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)


@query("scan_present", "SELECT event_id, value FROM events")
def scan_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.scan_present(spark, f"{sf_dir}/events.parquet", ["event_id", "no_such_column", "value"])


@query("persisted_model")
def persisted_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a classifier that was saved and loaded, beside those of the one in memory; fitted, so without SQL."""
    rows = _persistence(spark, sf_dir).where("said is not null").withColumn("t", F.when(F.col("value") < 15, 0).when(F.col("value") > 40, 2).otherwise(1)).persist()
    made, path = mo.softmax(rows, ["said"], "t"), _folder(spark)
    made.save(spark, path)
    both = [(name, me.classification_scores(m.predict(rows, ["t"]), "t", "predicted", [0, 1, 2])["macro_f1"]) for name, m in (("in_memory", made), ("loaded", mo.load(spark, path)))]
    return spark.createDataFrame(both, "model string, macro_f1 double")
