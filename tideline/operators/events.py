"""Change events, strict as-of history and delayed alignment."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .windows import delay_group

MICROS = 60_000_000


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def is_change(value: Column, order: Iterable[str], by: Iterable[str] = ()) -> Column:
    """A non-null value whose previous row is null or different: the same value after a gap is a change."""
    before = F.lag(value).over(W.partitionBy(*by).orderBy(*order))
    return value.isNotNull() & (before.isNull() | (value != before))


def change_events(df: DataFrame, value: str, order: Iterable[str] = ("prediction_time",), by: Iterable[str] = ()) -> DataFrame:
    return df.withColumn("__change", is_change(F.col(f"`{value}`"), order, by)).where("__change").drop("__change")


def vector_changes(df: DataFrame, columns: Iterable[str], order: str = "prediction_time", by: Iterable[str] = ()) -> DataFrame:
    """Rows where all (already filled) columns are known and any differs from the previous row."""
    columns = list(columns)
    now = F.struct(*[F.col(f"`{c}`") for c in columns])
    known = F.lit(True)
    for c in columns:
        known = known & F.col(f"`{c}`").isNotNull()
    marked = df.withColumns({"__before": F.lag(now).over(W.partitionBy(*by).orderBy(order)), "__now": now})
    return marked.where(known & ~F.col("__now").eqNullSafe(F.col("__before"))).drop("__before", "__now")


def strictly_before(value: Column, time: str, minutes: int, by: Iterable[str] = ()) -> Column:
    """value of the last row whose time is strictly earlier than this row's time less minutes. A window, not a join."""
    w = W.partitionBy(*by).orderBy(micros(time)).rangeBetween(W.unboundedPreceding, -(minutes * MICROS + 1))
    return F.last(value, ignorenulls=True).over(w)


def event_table(minute: DataFrame, assay: str, horizon: int, by: Iterable[str] = (), time: str = "prediction_time") -> DataFrame:
    """A row per assay change, keyed by prediction_time = event time - horizon, with what was known then.

    previous_fcao is the last event observed strictly before prediction_time; the immediate previous event
    may be too late to be known. Production, sampling and release times are unknown, hence null. The wall time
    of the historian is the only observed one.
    """
    by = list(by)
    events = change_events(minute.select(*by, F.col(time).alias("target_event_time"), F.col(f"`{assay}`").cast("double").alias("fcao")), "fcao", ["target_event_time"], by)
    order = W.partitionBy(*by).orderBy("target_event_time")
    unknown = F.lit(None).cast("timestamp")
    seen = F.struct("fcao", "target_event_time")
    rows = events.withColumns({"__at": F.col("target_event_time") - F.expr(f"interval {int(horizon)} minutes"), "__prior": F.lag(seen).over(order), "__known": strictly_before(seen, "target_event_time", horizon, by)})
    age = lambda a, b: (micros(a) - F.unix_micros(F.col(b).cast("timestamp"))) / MICROS
    return rows.select(
        *by, F.col("__at").alias("prediction_time"), "fcao", "target_event_time", F.col("target_event_time").alias("historian_observation_time"),
        unknown.alias("process_production_time"), unknown.alias("sample_time"), unknown.alias("laboratory_result_available_time"),
        F.col("__prior.fcao").alias("immediate_previous_fcao"), F.col("__prior.target_event_time").alias("immediate_previous_result_time"),
        F.col("__known.fcao").alias("previous_fcao"), F.col("__known.target_event_time").alias("previous_historian_observation_time"),
        age("target_event_time", "__prior.target_event_time").alias("previous_fcao_age_minutes_at_result"), age("__at", "__known.target_event_time").alias("previous_fcao_age_minutes_at_prediction"),
        F.col("__known").isNotNull().alias("previous_fcao_available_at_prediction_time"), F.lit("historian_observed_change").alias("time_semantics"),
    )


def event_timing(events: DataFrame) -> dict[str, int]:
    """How often the immediate previous event was not yet known, was replaced by an earlier one, or none was known."""
    prior, at = F.col("immediate_previous_result_time"), F.col("prediction_time")
    late = prior.isNotNull() & (prior > at)
    unavailable = prior.isNotNull() & (prior >= at)
    return events.agg(
        F.count("*").alias("events"), F.countDistinct("prediction_time").alias("distinct_prediction_times"), F.count_if(late).alias("events_late_under_immediate_rule"), F.count_if(unavailable).alias("events_immediate_not_strictly_available"),
        F.count_if(unavailable & F.col("previous_fcao").isNotNull()).alias("events_reassigned_to_earlier_result"), F.count_if(~F.col("previous_fcao_available_at_prediction_time")).alias("events_without_available_previous_result"),
    ).first().asDict()


def delayed_features(features: DataFrame, times: DataFrame, delays: Mapping[str, int], groups: Mapping[str, Collection[str]], columns: Iterable[str], by: Iterable[str] = (), time: str = "prediction_time") -> DataFrame:
    """For each of times, every feature group as it stood at time - delay: that minute's row, or else the one a minute before.

    The row decides, not the value: a present row with a null value gives null. Groups
    without a delay take 0. The features are read once: each row is offered to the times it can
    serve by an equi-join on the minute, and a maximum by time picks among the two.
    """
    by, columns = list(by), list(columns)
    group_of = {c: delay_group(c, groups) for c in columns}
    found = times.select(*by, time).distinct()
    wanted = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(int(delays.get(g, 0)) + back).alias("d"), F.lit(back).alias("back")) for g in sorted(set(group_of.values())) for back in (0, 1)])
    asks = found.select(*by, F.col(time).alias("__for"), F.explode(wanted).alias("w")).select(*by, "__for", "w.g", "w.back", (F.col("__for") - F.make_dt_interval(mins=F.col("w.d"))).alias(time))
    met = asks.join(features.select(*by, time, *[F.col(f"`{c}`") for c in columns]), [*by, time])
    picked = [F.min_by(F.col(f"`{c}`"), F.when(F.col("g") == g, F.col("back"))).alias(c) for c, g in group_of.items()]
    at = met.groupBy(*by, F.col("__for").alias(time)).agg(*picked)
    return found.join(at, [*by, time], "left").select(*by, time, *[F.col(f"`{c}`") for c in columns])


def lagged_pairs(df: DataFrame, x: str, y: str, lags: Iterable[int], order: str = "prediction_time", by: Iterable[str] = ()) -> DataFrame:
    """(lag, order, x as it stood lag rows earlier, y), for every lag, where both are known. One sort serves all lags."""
    w = W.partitionBy(*by).orderBy(order)
    both = F.array(*[F.struct(F.lit(int(k)).alias("lag"), F.lag(F.col(f"`{x}`"), int(k)).over(w).alias("x")) for k in lags])
    return df.select(*by, order, both.alias("p"), F.col(f"`{y}`").alias("y")).select(*by, order, F.explode("p").alias("p"), "y").select(*by, order, "p.lag", "p.x", "y").where("x is not null and y is not null")
