"""Registered queries of the time-series engine over the driver's tables, with their SQL.

In the events table event_type is the tag, value the reading, user_id the asset and ts the time;
event_id breaks ties. Computed doubles are rounded, as two engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import metrics as me
from ..operators import events as ev
from ..operators import models as mo
from ..operators import splits as sp
from ..operators import timebase as tb
from ..operators import windows as wi
from . import audit, gates, validation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where SQL can express it."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.select(*columns) if columns else df


def r(c: Column, places: int = 6) -> Column:
    return F.round(c, places)


USER, ORDER = ["user_id"], "ts"


def total_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series: the mean value of every occupied minute."""
    return tb.minutes(events(spark, sf_dir, "ts", "value"), ["value"], [], "ts")


# The same series in SQL.
_M = "m AS (SELECT date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, avg(value) AS value FROM events GROUP BY 1)"
_G = f"{_M}, g AS (SELECT unnest(generate_series((SELECT min(prediction_time) FROM m), (SELECT max(prediction_time) FROM m), interval 1 minute)) AS prediction_time), s AS (SELECT g.prediction_time, m.value FROM g LEFT JOIN m USING (prediction_time))"


# --- time base ------------------------------------------------------------------------


@query(
    "minute_bucket",
    """
    SELECT event_type, date_trunc('minute', ts)::timestamp AS bucket_start, date_trunc('minute', ts)::timestamp + interval 1 minute AS bucket_end,
           date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, round(mean_value, 6) AS mean_value, last_value
    FROM (SELECT event_type, date_trunc('minute', ts) AS ts, avg(CASE WHEN value BETWEEN 1 AND 90 THEN value END) AS mean_value,
                 arg_max(CASE WHEN value BETWEEN 1 AND 90 THEN value END, ts) AS last_value FROM events GROUP BY 1, 2)
    """,
)
def minute_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.clean(events(spark, sf_dir, "event_type", "ts", "value"), ["value"], {"value": (1.0, 90.0)}).withColumn("last", F.col("value"))
    out = tb.minutes(rows, ["value"], ["last"], "ts", ["event_type"])
    return out.select("event_type", "bucket_start", "bucket_end", "prediction_time", r(F.col("value")).alias("mean_value"), F.col("last").alias("last_value"))


@query("range_clean", "SELECT event_id, CASE WHEN value BETWEEN 10 AND 50 THEN value END AS value FROM events")
def range_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.clean(events(spark, sf_dir, "event_id", "value"), ["value"], {"value": (10.0, 50.0)})


@query("stable_filter", "SELECT o_orderkey, coalesce(o_totalprice > 100000 AND o_custkey > 10 AND CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey END > 50, false) AS stable FROM orders")
def stable_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("k", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey")))
    return rows.select("o_orderkey", tb.is_stable({"o_totalprice": 100000, "o_custkey": 10, "k": 50}).alias("stable"))


@query("grid_complete", f"WITH {_G} SELECT prediction_time, round(value, 6) AS value FROM s")
def grid_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.complete_grid(total_minutes(spark, sf_dir).select("prediction_time", "value")).select("prediction_time", r(F.col("value")).alias("value"))


@query(
    "forward_fill",
    "SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events",
)
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return rows.select("event_id", tb.forward_fill(["value"], "at", USER)["value"].alias("value"))


@query("forward_fill_chunked", f"WITH {_G} SELECT prediction_time, round(last_value(value IGNORE NULLS) OVER (ORDER BY prediction_time ROWS UNBOUNDED PRECEDING), 6) AS value FROM s")
def forward_fill_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = tb.complete_grid(total_minutes(spark, sf_dir).select("prediction_time", "value"))
    return tb.forward_fill_chunked(grid, ["value"]).select("prediction_time", r(F.col("value")).alias("value"))


@query("keep_last", "SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts)::timestamp AS ts FROM events GROUP BY 1")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id").agg(F.max_by("event_id", "ts").alias("event_id"), F.max("ts").alias("ts"))


# --- backward windows -----------------------------------------------------------------


@query(
    "causal_rolling",
    """
    SELECT event_id, round(CASE WHEN count(value) OVER w >= 5 THEN avg(value) OVER w END, 6) AS mean_10,
           round(CASE WHEN count(value) OVER w >= 5 THEN stddev_samp(value) OVER w END, 6) AS std_10,
           round(value - lag(value, 9) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS delta_10
    FROM (SELECT * REPLACE (CASE WHEN event_id % 4 > 0 THEN value END AS value) FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
    """,
)
def causal_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("value"))
    return rows.select("event_id", *[r(wi.trailing(F.col("value"), s, 10, "at", USER)).alias(f"{s}_10") for s in wi.STATISTICS])


def _features_sql() -> str:
    out = []
    for w in (10, 30):
        n = f"ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW"
        over = f"OVER (ORDER BY prediction_time {n})"
        for s, f in (("mean", "avg"), ("std", "stddev_samp")):
            out.append(f"round(CASE WHEN count(v) {over} >= {max(3, w // 2)} THEN {f}(v) {over} END::float::double, 3) AS value__{s}_{w}m")
        out.append(f"round((v - lag(v, {w - 1}) OVER (ORDER BY prediction_time))::float::double, 3) AS value__delta_{w}m")
    return f"WITH {_G}, f AS (SELECT prediction_time, value::float::double AS v FROM s) SELECT prediction_time, round(v, 3) AS value, {', '.join(out)} FROM f"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the complete series, in daily chunks that see a window's rows of the day before."""
    grid = tb.complete_grid(total_minutes(spark, sf_dir).select("prediction_time", "value"))
    make = lambda rows, by: wi.backward_features(rows, ["value"], [10, 30], "prediction_time", by, ["__own"])
    return wi.chunked(grid, make, before=30)


@query("backward_features", _features_sql())
def backward_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _features(spark, sf_dir)
    return x.select("prediction_time", *[r(F.col(c).cast("double"), 3).alias(c) for c in x.columns if c != "prediction_time"])


@query("recent_mean", "SELECT event_id, round(CASE WHEN count(value) OVER w >= 5 THEN avg(value) OVER w END, 6) AS recent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def recent_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", "value", F.struct("ts", "event_id").alias("at"))
    return rows.select("event_id", r(wi.trailing(F.col("value"), "mean", 10, "at", USER, least=5)).alias("recent"))


@query("lag_lead", "SELECT event_id, lag(value, 2) OVER w AS earlier, lead(value, 2) OVER w AS later FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def lag_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", "value", F.struct("ts", "event_id").alias("at"))
    w = W.partitionBy("user_id").orderBy("at")
    return rows.select("event_id", F.lag("value", 2).over(w).alias("earlier"), wi.future_value(F.col("value"), 2, "at", USER).alias("later"))


@query("stride_sample", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p FROM events WHERE value > 20) WHERE p % 5 = 0")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), "value").where("value > 20")
    return wi.every(rows, 5, "at", USER).select("event_id")


@query("average_rank", "SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS rnk FROM lineitem")
def average_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select("l_orderkey", "l_linenumber", wi.average_rank(F.col("l_quantity"), ["l_returnflag"]).alias("rnk"))


# --- forward windows and labels -------------------------------------------------------


@query(
    "future_window",
    """
    SELECT event_id, round(CASE WHEN count(value) OVER w = 4 THEN avg(value) OVER w END, 6) AS mean_2_5, CASE WHEN count(value) OVER w = 4 THEN min(value) OVER w END AS min_2_5,
           CASE WHEN count(value) OVER w = 4 THEN max(value) OVER w END AS max_2_5
    FROM (SELECT * REPLACE (CASE WHEN event_id % 9 > 0 THEN value END AS value) FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 FOLLOWING AND 5 FOLLOWING)
    """,
)
def future_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("v"))
    get = lambda how: wi.future_aggregate(F.col("v"), 2, 5, how, "at", USER)
    return rows.select("event_id", r(get("mean")).alias("mean_2_5"), get("min").alias("min_2_5"), get("max").alias("max_2_5"))


@query("future_all_valid", "SELECT event_id, count(CASE WHEN value > 5 THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) = 3 AS ok FROM events")
def future_all_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", "value", F.struct("ts", "event_id").alias("at"))
    return rows.select("event_id", wi.future_all(F.col("value") > 5, 1, 3, "at", USER).alias("ok"))


_DELTA = "value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query("deadband_label", f"SELECT event_id, CASE WHEN d < -5 THEN 0 WHEN d > 5 THEN 2 WHEN d IS NOT NULL THEN 1 END AS trend, CASE WHEN d < -5 THEN 0 WHEN d > 5 THEN 2 ELSE 1 END AS trend_or_steady FROM (SELECT event_id, {_DELTA} AS d FROM events)")
def deadband_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", "value", F.struct("ts", "event_id").alias("at"))
    rows = rows.withColumn("d", F.col("value") - F.lag("value").over(W.partitionBy("user_id").orderBy("at")))
    return rows.select("event_id", wi.deadband_label(F.col("d"), 5).alias("trend"), wi.deadband_label(F.col("d"), 5, True).alias("trend_or_steady"))


@query("grade_map", "SELECT p_partkey, CASE WHEN g IN (1, 2) THEN 0 WHEN g = 3 THEN 1 WHEN g IN (4, 5) THEN 2 END AS state FROM (SELECT p_partkey, round_even(p_size / 8.0, 0) AS g FROM part)")
def grade_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", wi.grade_class(F.col("p_size") / 8.0).alias("state"))


@query(
    "future_trend",
    f"""
    WITH {_G}, f AS (SELECT prediction_time, last_value(value IGNORE NULLS) OVER (ORDER BY prediction_time ROWS UNBOUNDED PRECEDING) AS v FROM s),
    t AS (SELECT prediction_time, CASE WHEN count(v) OVER (ORDER BY prediction_time ROWS BETWEEN 25 FOLLOWING AND 35 FOLLOWING) = 11 THEN avg(v) OVER (ORDER BY prediction_time ROWS BETWEEN 25 FOLLOWING AND 35 FOLLOWING) END AS ahead,
                 CASE WHEN count(v) OVER (ORDER BY prediction_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) >= 5 THEN avg(v) OVER (ORDER BY prediction_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS recent FROM f)
    SELECT prediction_time, round(ahead, 6) AS future_mean, round(recent, 6) AS recent_mean, CASE WHEN ahead - recent < -7.0005 THEN 0 WHEN ahead - recent > 7.0005 THEN 2 WHEN ahead - recent IS NOT NULL THEN 1 END AS trend FROM t
    """,
)
def future_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = tb.forward_fill_chunked(tb.complete_grid(total_minutes(spark, sf_dir).select("prediction_time", "value")), ["value"])

    def make(rows: DataFrame, by: list[str]) -> DataFrame:
        v = F.col("value")
        return rows.select(*by, "__own", "prediction_time", wi.future_aggregate(v, 25, 35, "mean", by=by).alias("ahead"), wi.trailing(v, "mean", 10, by=by, least=5).alias("recent"))

    rows = wi.chunked(filled, make, before=10, after=35)
    return rows.select("prediction_time", r(F.col("ahead")).alias("future_mean"), r(F.col("recent")).alias("recent_mean"), wi.deadband_label(F.col("ahead") - F.col("recent"), 7.0005).alias("trend"))


# --- events ---------------------------------------------------------------------------

_STEP = "floor(value / 20)"


@query(
    "change_events",
    f"SELECT event_id, v FROM (SELECT event_id, {_STEP} AS v, lag({_STEP}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM (SELECT * REPLACE (CASE WHEN event_id % 11 > 0 THEN value END AS value) FROM events)) WHERE v IS NOT NULL AND (b IS NULL OR v <> b)",
)
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.floor(F.when(F.col("event_id") % 11 > 0, F.col("value")) / 20).cast("double").alias("v"))
    return ev.change_events(rows, "v", ["at"], USER).select("event_id", "v")


@query(
    "vector_changes",
    "SELECT event_id FROM (SELECT event_id, a, b, lag(a) OVER w AS a0, lag(b) OVER w AS b0 FROM (SELECT event_id, ts, user_id, floor(value / 40) AS a, event_type AS b FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE a IS NOT NULL AND b IS NOT NULL AND NOT (a IS NOT DISTINCT FROM a0 AND b IS NOT DISTINCT FROM b0)",
)
def vector_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.floor(F.col("value") / 40).alias("a"), F.col("event_type").alias("b"))
    return ev.vector_changes(rows, ["a", "b"], "at", USER).select("event_id")


@query(
    "strict_asof",
    "SELECT a.event_id, b.ts::timestamp AS known_ts, b.value AS known_value FROM events a ASOF LEFT JOIN (SELECT user_id, ts, value FROM events) b ON a.user_id = b.user_id AND a.ts - interval 60 minute > b.ts",
)
def strict_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "user_id", "ts", "value").withColumn("k", ev.strictly_before(F.struct("ts", "value"), "ts", 60, USER))
    return rows.select("event_id", F.col("k.ts").alias("known_ts"), F.col("k.value").alias("known_value"))


_EVENT_TABLE = """
    c AS (SELECT user_id, ts::timestamp AS t, floor(value / 20) AS v, lag(floor(value / 20)) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events),
    e AS (SELECT user_id, t, v AS fcao, lag(v) OVER w AS iv, lag(t) OVER w AS it FROM c WHERE v IS NOT NULL AND (b IS NULL OR v <> b) WINDOW w AS (PARTITION BY user_id ORDER BY t)),
    x AS (SELECT e.*, k.fcao AS pv, k.t AS pt FROM e ASOF LEFT JOIN (SELECT user_id, t, fcao FROM e) k ON e.user_id = k.user_id AND e.t - interval 60 minute > k.t)
"""


def _event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "user_id", F.col("ts").alias("prediction_time"), F.floor(F.col("value") / 20).cast("double").alias("assay"))
    return ev.event_table(rows, "assay", 60, USER)


@query(
    "event_table",
    f"""
    WITH {_EVENT_TABLE} SELECT user_id, t - interval 60 minute AS prediction_time, t AS target_event_time, fcao, iv AS immediate_previous_fcao, it AS immediate_previous_result_time, pv AS previous_fcao,
    pt AS previous_historian_observation_time, epoch_us(t - it) / 6e7 AS previous_fcao_age_minutes_at_result, epoch_us(t - interval 60 minute - pt) / 6e7 AS previous_fcao_age_minutes_at_prediction,
    pt IS NOT NULL AS previous_fcao_available_at_prediction_time FROM x
    """,
)
def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _event_table(spark, sf_dir)
    unknown = ["historian_observation_time", "process_production_time", "sample_time", "laboratory_result_available_time", "time_semantics"]
    return t.drop(*unknown)


@query(
    "event_timing",
    f"""
    WITH {_EVENT_TABLE} SELECT count(*) AS events, count(DISTINCT t) AS distinct_prediction_times, count(*) FILTER (it > t - interval 60 minute) AS events_late_under_immediate_rule,
    count(*) FILTER (it >= t - interval 60 minute) AS events_immediate_not_strictly_available, count(*) FILTER (it >= t - interval 60 minute AND pv IS NOT NULL) AS events_reassigned_to_earlier_result,
    count(*) FILTER (pt IS NULL) AS events_without_available_previous_result FROM x
    """,
)
def event_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([ev.event_timing(_event_table(spark, sf_dir))])


@query(
    "group_delay_align",
    """
    WITH f AS (SELECT date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS x, round(max(value), 6) AS y FROM events GROUP BY 1),
    a AS (SELECT DISTINCT date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time FROM events)
    SELECT a.prediction_time, CASE WHEN p.prediction_time IS NOT NULL THEN p.x ELSE q.x END AS x, CASE WHEN u.prediction_time IS NOT NULL THEN u.y ELSE v.y END AS y FROM a
    LEFT JOIN f p ON p.prediction_time = a.prediction_time - interval 30 minute LEFT JOIN f q ON q.prediction_time = a.prediction_time - interval 31 minute
    LEFT JOIN f u ON u.prediction_time = a.prediction_time - interval 5 minute LEFT JOIN f v ON v.prediction_time = a.prediction_time - interval 6 minute
    """,
)
def group_delay_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = (F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.expr("interval 1 minute")).alias("prediction_time")
    rows = events(spark, sf_dir)
    f = rows.groupBy(minute).agg(r(F.avg(F.when(F.col("event_type") == "click", F.col("value")))).alias("x"), r(F.max("value")).alias("y"))
    times = rows.select(minute).distinct()
    return ev.delayed_features(f, times, {"slow": 30, "fast": 5}, {"slow": {"x"}, "fast": {"y"}}, ["x", "y"])


# --- splits ---------------------------------------------------------------------------

_PLACED = "p AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS k, count(*) OVER () AS n FROM events), b AS (SELECT max(CASE WHEN k = floor(n * 0.7::double) THEN ts END) AS b1, max(CASE WHEN k = floor(n * 0.85::double) THEN ts END) AS b2 FROM p)"


@query("chrono_split", f"WITH {_PLACED} SELECT event_id, CASE WHEN ts < b1 THEN 'train' WHEN ts < b2 THEN 'validation' ELSE 'test' END AS part FROM p, b")
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.purged_split(events(spark, sf_dir, "event_id", "ts"), 0, "ts").select("event_id", "part")


@query("purged_split", f"WITH {_PLACED} SELECT event_id, CASE WHEN ts < b1 - interval 35 minute THEN 'train' WHEN ts >= b2 THEN 'test' ELSE 'validation' END AS part FROM p, b WHERE ts < b1 - interval 35 minute OR (ts >= b1 AND ts < b2 - interval 35 minute) OR ts >= b2")
def purged_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sp.purged_split(events(spark, sf_dir, "event_id", "ts"), 35, "ts")
    sp.check_split(out, 35, "ts")
    return out.select("event_id", "part")


@query("week_folds", "SELECT date_trunc('week', ts)::timestamp AS week, count(*) AS events, min(ts)::timestamp AS first_ts, max(ts)::timestamp AS last_ts FROM events GROUP BY 1")
def week_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(sp.week_of("ts").cast("timestamp_ntz").alias("week")).agg(F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("label_hist", "SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1")
def label_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_orderstatus").alias("label")).agg(F.count("*").alias("n"))


@query("sample_summary", "SELECT count(*) AS rows, ((count(*) + 4) // 5)::BIGINT AS rows_after_stride, count(value) AS target_nonnull, min(value) AS target_min, max(value) AS target_max, round(avg(value), 6) AS target_mean FROM events")
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sp.sample_summary(events(spark, sf_dir, "ts", "value"), "value", 5, time="ts")
    keys = ["rows", "rows_after_stride", "target_nonnull", "target_min", "target_max"]
    return spark.createDataFrame([(*[s[k] for k in keys], round(s["target_mean"], 6))], [*keys, "target_mean"])


# --- statistics -----------------------------------------------------------------------


@query("quantile_profile", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 6) AS iqr FROM lineitem GROUP BY 1")
def quantile_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("l_extendedprice")
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.75)))
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(r(F.median(c)).alias("median"), r(q[1] - q[0]).alias("iqr"))


@query("pearson_spearman", "WITH x AS (SELECT l_returnflag, l_quantity, l_extendedprice, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b FROM lineitem) SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 9) AS pearson, round(corr(a, b), 9) AS spearman FROM x GROUP BY 1")
def pearson_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = me.with_ranks(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    return rows.groupBy("l_returnflag").agg(r(me.correlation(F.col("l_quantity"), F.col("l_extendedprice")), 9).alias("pearson"), r(me.correlation(F.col("rank_l_quantity"), F.col("rank_l_extendedprice")), 9).alias("spearman"))


@query("fisher_ci", "SELECT l_returnflag, round(tanh(atanh(r) - 1.96 / sqrt(n - 3)), 9) AS low, round(tanh(atanh(r) + 1.96 / sqrt(n - 3)), 9) AS high FROM (SELECT l_returnflag, corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem GROUP BY 1)")
def fisher_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(me.correlation(F.col("l_quantity"), F.col("l_extendedprice")).alias("r"), F.count("*").alias("n"))
    low, high = me.fisher_columns(F.col("r"), F.col("n"))
    return got.select("l_returnflag", r(low, 9).alias("low"), r(high, 9).alias("high"))


_LAGS = (0, 30, 60, 90, 120)


def _lag_sql() -> str:
    parts = [f"SELECT {k} AS lag_minutes, prediction_time, lag(value, {k}) OVER (ORDER BY prediction_time) AS x, y FROM f" for k in _LAGS]
    return f"""
    WITH {_G}, f AS (SELECT prediction_time, last_value(value IGNORE NULLS) OVER w AS value, last_value(y IGNORE NULLS) OVER w AS y FROM s
    LEFT JOIN (SELECT date_trunc('minute', ts)::timestamp + interval 1 minute AS prediction_time, max(value) AS y FROM events GROUP BY 1) USING (prediction_time) WINDOW w AS (ORDER BY prediction_time ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE x IS NOT NULL AND y IS NOT NULL),
    q AS (SELECT *, rank() OVER (PARTITION BY lag_minutes ORDER BY x) + (count(*) OVER (PARTITION BY lag_minutes, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY lag_minutes ORDER BY y) + (count(*) OVER (PARTITION BY lag_minutes, y) - 1) / 2.0 AS ry FROM p),
    z AS (SELECT lag_minutes, count(*) AS n, corr(x, y) AS r, corr(rx, ry) AS rho FROM q GROUP BY 1)
    """


def _lag_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.minutes(events(spark, sf_dir, "ts", "value", F.col("value").alias("y")), ["value"], [], "ts")
    top = events(spark, sf_dir).groupBy((F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.expr("interval 1 minute")).alias("prediction_time")).agg(F.max("value").alias("y"))
    grid = tb.complete_grid(rows.select("prediction_time", "value")).join(top, "prediction_time", "left")
    return audit.lag_scan(grid, {"all": ("value", "y")}, _LAGS)


@query("lag_scan_corr", f"{_lag_sql()} SELECT lag_minutes, n AS overlap_rows, round(r, 6) AS pearson_r, round(rho, 6) AS spearman_r, round(tanh(atanh(r) - 1.96 / sqrt(n - 3)), 6) AS ci95_low FROM z")
def lag_scan_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag_scan(spark, sf_dir).select("lag_minutes", "overlap_rows", r(F.col("pearson_r")).alias("pearson_r"), r(F.col("spearman_r")).alias("spearman_r"), r(F.col("ci95_low")).alias("ci95_low"))


@query("peak_lag", f"{_lag_sql()} SELECT lag_minutes, round(r, 6) AS pearson_r FROM z ORDER BY abs(r) DESC, lag_minutes LIMIT 1")
def peak_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.peaks(_lag_scan(spark, sf_dir)).select("lag_minutes", r(F.col("pearson_r")).alias("pearson_r"))


@query("mode", "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS k FROM events GROUP BY 1, 2) WHERE k = 1")
def mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id").agg(F.mode("event_type", True).alias("event_type"))


@query("class_count", "SELECT count(DISTINCT o_orderstatus) AS classes, count(DISTINCT o_orderpriority) AS priorities FROM orders")
def class_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.countDistinct("o_orderstatus").alias("classes"), F.countDistinct("o_orderpriority").alias("priorities"))


@query("cluster_profile", "SELECT p_size % 4 AS cluster, round(avg(p_retailprice), 6) AS price, round(avg(CASE WHEN p_partkey % 5 > 0 THEN p_size END), 6) AS size FROM part GROUP BY 1")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select((F.col("p_size") % 4).alias("cluster"), F.col("p_retailprice").alias("price"), F.when(F.col("p_partkey") % 5 > 0, F.col("p_size")).alias("size"))
    return mo.cluster_means(p, "cluster", ["price", "size"]).select("cluster", r(F.col("price")).alias("price"), r(F.col("size")).alias("size"))


# --- scores and gates -----------------------------------------------------------------

_PAIRS = "p AS (SELECT week, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS said FROM (SELECT *, date_trunc('week', ts)::timestamp AS week FROM events))"


def _persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return rows.select(sp.week_of("ts").cast("timestamp_ntz").alias("week"), "value", F.lag("value").over(W.partitionBy("user_id").orderBy("at")).alias("said"))


@query("regression_metrics", f"WITH {_PAIRS} SELECT week, count(*) AS n, round(avg(abs(value - said)), 6) AS mae, round(sqrt(avg((value - said) ** 2)), 6) AS rmse, round(1 - avg((value - said) ** 2) / var_pop(value), 6) AS r2 FROM p WHERE said IS NOT NULL GROUP BY 1")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = me.regression_scores(_persistence(spark, sf_dir), "value", "said", ["week"])
    return s.select("week", "n", *[r(F.col(c)).alias(c) for c in ("mae", "rmse", "r2")])


_CLASS = "CASE WHEN {0} < 15 THEN 0 WHEN {0} > 40 THEN 2 ELSE 1 END"


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = lambda c: F.when(F.col(c) < 15, 0).when(F.col(c) > 40, 2).otherwise(1)
    return _persistence(spark, sf_dir).where("said is not null").select(f("value").alias("t"), f("said").alias("p"))


_CONFUSION = f"{_PAIRS}, c AS (SELECT {_CLASS.format('value')} AS t, {_CLASS.format('said')} AS q FROM p WHERE said IS NOT NULL), g AS (SELECT a.l AS truth, b.l AS predicted, (SELECT count(*) FROM c WHERE t = a.l AND q = b.l) AS n FROM (VALUES (0), (1), (2)) a(l), (VALUES (0), (1), (2)) b(l))"


@query("confusion", f"WITH {_CONFUSION} SELECT truth, predicted, n FROM g")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.confusion(_classes(spark, sf_dir), "t", "p", [0, 1, 2])


@query(
    "macro_f1",
    f"WITH {_CONFUSION} SELECT round(avg(CASE WHEN t + s > 0 THEN 2.0 * h / (t + s) ELSE 0 END), 9) AS macro_f1 FROM (SELECT truth, sum(n) AS t, sum(CASE WHEN truth = predicted THEN n ELSE 0 END) AS h FROM g GROUP BY 1) a JOIN (SELECT predicted, sum(n) AS s FROM g GROUP BY 1) b ON a.truth = b.predicted",
)
def macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.macro_f1(me.confusion(_classes(spark, sf_dir), "t", "p", [0, 1, 2]), 3).select(r(F.col("macro_f1"), 9).alias("macro_f1"))


@query("fold_summary", f"WITH {_PAIRS}, f AS (SELECT week, avg(abs(value - said)) AS m, avg(abs(value - 30)) AS b FROM p WHERE said IS NOT NULL GROUP BY 1) SELECT count(*) AS folds, round(avg(m), 6) AS mean_model_mae, round(1 - avg(m) / avg(b), 6) AS mean_improvement, bool_and(m < b) AS all_better FROM f")
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _persistence(spark, sf_dir).where("said is not null").withColumn("base", F.lit(30.0))
    one = lambda c, n: me.regression_scores(rows, "value", c, ["week"]).select("week", F.col("mae").alias(n))
    folds = [{"model": {"mae": x["m"]}, "baseline": {"mae": x["b"]}} for x in one("said", "m").join(one("base", "b"), "week").collect()]  # a row for each week
    done = validation.summarise_regression(folds)
    found = (done["fold_count"], round(done["mean_model_mae"], 6), round(done["mean_improvement"], 6), done["all_folds_model_beats_baseline"])
    return spark.createDataFrame([found], "folds long, mean_model_mae double, mean_improvement double, all_better boolean")


_FOLDS = "SELECT date_trunc('week', ts)::timestamp AS w, round(avg(value), 6) AS m, round(max(value), 6) AS b FROM events WHERE event_type = '{0}' AND ts {1} (SELECT min(ts) + interval 15 day FROM events) GROUP BY 1"


@query("fold_union", f"SELECT coalesce(x.w, y.w) AS fold, x.m AS model_before, x.b AS baseline_before, y.m AS model_after, y.b AS baseline_after FROM ({_FOLDS.format('click', '<')}) x FULL JOIN ({_FOLDS.format('view', '>=')}) y ON x.w = y.w")
def fold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    edge = F.lit(rows.agg(F.min("ts")).first()[0]).cast("timestamp_ntz") + F.expr("interval 15 days")

    def folds(kind: str, part: Column) -> DataFrame:
        return rows.where((F.col("event_type") == kind) & part).groupBy(sp.week_of("ts").cast("timestamp_ntz").alias("fold")).agg(r(F.avg("value")).alias("model"), r(F.max("value")).alias("baseline")).withColumn("test_week", F.lit(""))

    both = gates.compare_folds(folds("click", F.col("ts") < edge), folds("view", F.col("ts") >= edge))
    return both.select("fold", "model_before", "baseline_before", "model_after", "baseline_after")


@query("direction_gate", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN value < 20 THEN 'raise' WHEN value > 40 THEN 'lower' WHEN value IS NOT NULL THEN 'hold' END END AS direction, NULL::VARCHAR AS actuator FROM events")
def direction_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", "value")
    return rows.select("event_id", gates.direction_column(F.col("value"), 30, 10, F.col("event_id") % 2 == 0).alias("direction"), F.lit(None).cast("string").alias("actuator"))


# --- audits and rows ------------------------------------------------------------------


_LOG = "'等级' || CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END || (event_id % 7)::VARCHAR || CASE WHEN event_id % 5 = 0 THEN '' ELSE '，' || event_type END"


@query("regex_extract", f"SELECT event_id, CASE WHEN event_id % 4 > 0 THEN try_cast(nullif(regexp_extract({_LOG}, '等级\\s*(\\d+)', 1), '') AS DOUBLE) END AS number FROM events")
def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("等级"), F.when(F.col("event_id") % 3 == 0, " ").otherwise(""), (F.col("event_id") % 7).cast("string"), F.when(F.col("event_id") % 5 == 0, "").otherwise(F.concat(F.lit("，"), F.col("event_type"))))
    rows = events(spark, sf_dir, "event_id", "event_type").withColumn("log", F.when(F.col("event_id") % 4 > 0, text).otherwise("none"))
    return rows.select("event_id", audit.logged_grade("log").alias("number"))


@query("audit_counts", "SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS common_nonnull, count(*) FILTER (a = b) AS equal, count(*) FILTER (a <> b) AS mismatch FROM (SELECT CASE WHEN l_linenumber > 1 THEN l_quantity END AS a, CASE WHEN l_orderkey % 3 > 0 THEN l_quantity + l_orderkey % 2 END AS b FROM lineitem)")
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("a"), F.when(F.col("l_orderkey") % 3 > 0, F.col("l_quantity") + F.col("l_orderkey") % 2).alias("b"))
    return spark.createDataFrame([audit.equality_counts(rows, "a", "b")])


@query("tail_n", "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000")
def tail_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).orderBy(F.desc("ts"), F.desc("event_id")).limit(2000).select("event_id", "value")


@query("last_qualifying", "SELECT user_id, arg_max(event_id, ts) AS event_id FROM events WHERE value > 30 GROUP BY 1")
def last_qualifying(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("value > 30").groupBy("user_id").agg(F.max_by("event_id", "ts").alias("event_id"))


@query("known_rows", "SELECT event_id, x IS NOT NULL OR y IS NOT NULL AS some, x IS NOT NULL AND y IS NOT NULL AS every FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS x, CASE WHEN event_id % 3 = 0 THEN value END AS y FROM events)")
def known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir, "event_id", F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("x"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("y"))
    return rows.select("event_id", wi.any_known(["x", "y"]).alias("some"), wi.all_known(["x", "y"]).alias("every"))


@query("index_overlap", "SELECT count(*) AS shared FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def index_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = lambda f: rows.where(F.col("l_returnflag") == f).select("l_orderkey").distinct()
    return keys("R").join(keys("A"), "l_orderkey", "left_semi").agg(F.count("*").alias("shared"))


# --- fitted models (no SQL; their tests use closed forms) -----------------------------


def _learnable(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    x = _features(spark, sf_dir)
    columns = [c for c in x.columns if "__" in c]
    filled = tb.forward_fill(["value"], "prediction_time")["value"].cast("double")
    rows = x.withColumn("v", filled)
    rows = rows.withColumns({"target": wi.future_aggregate(F.col("v"), 25, 35, "mean"), "recent": wi.trailing(F.col("v"), "mean", 10, least=5)})
    rows = rows.withColumn("trend", wi.deadband_label(F.col("target") - F.col("recent"), 3.0)).where("target is not null and recent is not null")
    return rows.withColumn("prediction_time", F.col("prediction_time").cast("timestamp")).persist(), columns


@query("ridge_split")
def ridge_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns = _learnable(spark, sf_dir)
    parts = sp.purged_split(rows, 35)
    model = mo.ridge(wi.every(parts.where("part = 'train'"), 5), columns, "target", 20.0)
    return me.regression_scores(model.predict(parts.where("part = 'test'"), ["target"]), "target", "predicted")


@query("softmax_split")
def softmax_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns = _learnable(spark, sf_dir)
    parts = sp.purged_split(rows, 35)
    model = mo.softmax(wi.every(parts.where("part = 'train'"), 5), columns, "trend")
    return me.confusion(model.predict(parts.where("part = 'test'"), ["trend"]), "trend", "predicted", [0, 1, 2])


@query("weekly_validation")
def weekly_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns = _learnable(spark, sf_dir)
    x = rows.select("prediction_time", *columns)
    done = validation.weekly_regression(rows, lambda _: (x, columns, {}), "target", "recent", 35, 5, 20.0, 2)
    return spark.createDataFrame([(f["fold"], f["test_week"], f["model"]["mae"], f["baseline"]["mae"], f["model_beats_baseline"]) for f in done["folds"]], "fold int, test_week string, model_mae double, baseline_mae double, better boolean")


@query("cluster_select")
def cluster_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("prediction_time"), F.col("p_size").cast("double").alias("a"), "p_retailprice")
    found = mo.fit_clusters(rows, ["a", "p_retailprice"], 2, 4, 7)
    which, far = found.columns()
    return rows.select("prediction_time", which.alias("cluster"), far.alias("distance")).groupBy("cluster").agg(F.count("*").alias("n"), F.avg("distance").alias("mean_distance"))


@query("delay_select")
def delay_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _features(spark, sf_dir).withColumn("prediction_time", F.col("prediction_time").cast("timestamp"))
    columns = [c for c in x.columns if "__" in c]
    marks = events(spark, sf_dir).where("event_type = 'error'").select(F.date_trunc("minute", "ts").alias("prediction_time"), "value").groupBy("prediction_time").agg(F.min("value").alias("fcao"))
    marks = marks.withColumn("previous_fcao", F.lag("fcao").over(W.orderBy("prediction_time"))).where("previous_fcao is not null")
    chosen, _ = mo.select_delays(x.persist(), marks.persist(), {"all": [0, 30, 60]}, {"all": {"value"}}, columns)
    return spark.createDataFrame(list(chosen.items()), "feature_group string, delay_minutes int")
