"""From raw readings to a clean minute series with explicit time anchors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..spec import TIME_ANCHORS, SeriesSpec

MINUTE = "interval 1 minute"


def finite(column: str) -> Column:
    """A number, or null for NaN and the infinities."""
    c = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def clean(df: DataFrame, numbers: Iterable[str], ranges: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """NaN, infinities and values outside their inclusive range become null; nothing else changes."""
    found = {}
    for c in numbers:
        if c in df.columns:
            value = finite(c)
            if ranges and c in ranges:
                low, high = ranges[c]
                value = F.when(value.between(low, high), value)
            found[c] = value
    return df.withColumns(found) if found else df


def is_stable(above: Mapping[str, float]) -> Column:
    """Every column strictly above its limit; a null counts as not above."""
    held = F.lit(True)
    for c, limit in above.items():
        held = held & (F.col(f"`{c}`") > limit)
    return F.coalesce(held, F.lit(False))


def with_anchors(df: DataFrame, bucket_start: str = "bucket_start") -> DataFrame:
    """Bucket [bucket_start, bucket_end); what it holds is known from prediction_time = bucket_end on."""
    end = F.col(bucket_start) + F.expr(MINUTE)
    return df.withColumns({"bucket_start": F.col(bucket_start), "bucket_end": end, "prediction_time": end})


def check_minutes(df: DataFrame, by: Iterable[str] = ()) -> None:
    """Raise unless the anchors are there, a minute apart, and unique in each series."""
    missing = sorted(set(TIME_ANCHORS) - set(df.columns))
    if missing:
        raise AssertionError(f"time anchors are missing: {missing}")
    wrong = F.count_if(~F.coalesce((F.col("bucket_end") == F.col("bucket_start") + F.expr(MINUTE)) & (F.col("prediction_time") == F.col("bucket_end")), F.lit(False)))
    found = df.agg(wrong.alias("wrong")).first()
    repeated = df.groupBy(*by, "prediction_time").count().where("count > 1").limit(1).count()
    if found["wrong"] or repeated:
        raise AssertionError(f"{found['wrong']} minutes break the anchor contract; repeated minutes: {bool(repeated)}")


def minutes(df: DataFrame, mean: Iterable[str], last: Iterable[str], time: str = "time", by: Iterable[str] = (), tie: str | None = None) -> DataFrame:
    """One row per occupied minute (of each series): means, and last non-null readings, with anchors.

    A partial and final aggregate; input order does not matter. Readings of one instant
    are ordered by the tie column if given.
    """
    at = F.col(time) if tie is None else F.struct(F.col(time), F.col(tie))
    start = F.date_trunc("minute", F.col(time)).cast(df.schema[time].dataType).alias("bucket_start")
    means = [F.avg(f"`{c}`").alias(c) for c in mean]
    lasts = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), at)).alias(c) for c in last]
    return with_anchors(df.groupBy(*by, start).agg(*means, *lasts))


def minute_series(raw: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Clean raw readings and reduce them to the minute frame of a spec."""
    missing = sorted(set(spec.read_columns) - set(raw.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    numbers = [c for c in spec.read_columns if c != spec.time and c not in spec.by]
    rows = clean(raw.select(*[F.col(f"`{c}`") for c in spec.read_columns]), numbers, spec.ranges)
    rows = rows.withColumn(spec.time, F.col(spec.time).cast("timestamp"))
    return minutes(rows, spec.mean_columns, spec.last_columns, spec.time, spec.by)


def complete_grid(df: DataFrame, time: str = "prediction_time", by: Iterable[str] = ()) -> DataFrame:
    """Add a row of nulls for every missing minute between the first and last of each series."""
    by = list(by)
    ends = df.groupBy(*by).agg(F.min(time).alias("a"), F.max(time).alias("b")) if by else df.agg(F.min(time).alias("a"), F.max(time).alias("b")).where("a is not null")
    grid = ends.select(*by, F.explode(F.expr(f"sequence(a, b, {MINUTE})")).alias(time))
    return grid.join(df, [*by, time], "left")


def forward_fill(columns: Iterable[str], order: str = "prediction_time", by: Iterable[str] = ()) -> dict[str, Column]:
    """The last non-null value up to each row; never a later one."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return {c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(w) for c in columns}


def forward_fill_chunked(df: DataFrame, columns: Iterable[str], order: str = "prediction_time", by: Iterable[str] = (), chunk: str = "day") -> DataFrame:
    """forward_fill of one very long series, in parallel: within chunks of time, then from the last value of earlier chunks.

    Only one row for each chunk meets in a task of its own.
    """
    by, columns = list(by), list(columns)
    rows = df.withColumn("__chunk", F.date_trunc(chunk, order))
    ends = rows.groupBy(*by, "__chunk").agg(*[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(order))).alias(f"__{c}") for c in columns])
    before = W.partitionBy(*by).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*by, "__chunk", *[F.last(f"__{c}", ignorenulls=True).over(before).alias(f"__{c}") for c in columns])
    near = rows.withColumns(forward_fill(columns, order, [*by, "__chunk"]))
    on = [near[k].eqNullSafe(carried[k]) for k in [*by, "__chunk"]]
    kept = [near[c] for c in df.columns if c not in columns]
    return near.join(carried, on, "left").select(*kept, *[F.coalesce(near[c], carried[f"__{c}"]).alias(c) for c in columns]).select(*df.columns)
