"""Backward features and forward targets by row windows, and the contracts on feature names."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..spec import SeriesSpec

CLUSTER_COLUMNS = ("material_cluster", "material_cluster_distance")
STATISTICS = ("mean", "std", "delta")


def _rows(first: int, last: int, order: str, by: Iterable[str]):
    return W.partitionBy(*by).orderBy(order).rowsBetween(first, last)


# --- backward ---------------------------------------------------------------------


def trailing(value: Column, statistic: str, width: int, order: str = "prediction_time", by: Iterable[str] = (), least: int | None = None) -> Column:
    """Mean, sample deviation, or difference to the first row, of the last width rows.

    mean and std need least non-null values (a third of a short window, half of a long one:
    max(3, width // 2)); delta needs both ends.
    """
    if statistic == "delta":
        return value - F.lag(value, width - 1).over(W.partitionBy(*by).orderBy(order)) if width > 1 else value - value
    w = _rows(-(width - 1), 0, order, by)
    least = max(3, width // 2) if least is None else least
    what = {"mean": F.avg, "std": F.stddev_samp}[statistic]
    return F.when(F.count(value).over(w) >= least, what(value).over(w))


def backward_features(df: DataFrame, columns: Iterable[str], windows: Iterable[int], order: str = "prediction_time", by: Iterable[str] = (), keep: Iterable[str] = ()) -> DataFrame:
    """Each column as float, and its trailing statistics, named <column>__<statistic>_<width>m.

    One select over one partitioning and order, so one sort serves all windows.
    """
    by, out = list(by), []
    for c in columns:
        value = F.col(f"`{c}`").cast("float").cast("double")
        out.append(value.cast("float").alias(c))
        out += [trailing(value, s, w, order, by).cast("float").alias(f"{c}__{s}_{w}m") for w in windows for s in STATISTICS]
    return df.select(*by, order, *keep, *out)


def chunked(df: DataFrame, f: Callable[[DataFrame, list[str]], DataFrame], before: int, after: int = 0, order: str = "prediction_time", by: Iterable[str] = (), chunk_minutes: int = 1440) -> DataFrame:
    """f over a gap-free minute series in parallel chunks, each with the before rows ahead and after rows behind that f's windows see.

    f takes a frame and its partition columns. Every row comes out once. Only on a complete grid is a
    number of rows a length of time, as this needs.
    """
    by = list(by)
    minute = F.floor(F.unix_micros(F.col(order).cast("timestamp")) / 60_000_000)
    own = F.floor(minute / chunk_minutes)
    # a row is also seen by chunks whose rows come up to before minutes later or after minutes earlier
    spread = F.explode(F.sequence(F.floor((minute - after) / chunk_minutes), F.floor((minute + before) / chunk_minutes)))
    rows = df.withColumns({"__own": own}).withColumn("__chunk", spread)
    out = f(rows, [*by, "__chunk"])
    return out.where("__own = __chunk").drop("__own", "__chunk")


# --- forward ----------------------------------------------------------------------


def check_gapless(df: DataFrame, order: str = "prediction_time", by: Iterable[str] = ()) -> None:
    """Raise unless each series has exactly one row for every minute of its span."""
    key = df.groupBy(*by)
    t = F.unix_micros(F.col(order).cast("timestamp"))
    bad = key.agg((F.count("*") != (F.max(t) - F.min(t)) / 60_000_000 + 1).alias("a"), (F.count("*") != F.countDistinct(order)).alias("b"), F.count_if(F.col(order).isNull()).alias("c")).where("a or b or c > 0")
    if bad.limit(1).count():
        raise ValueError("the series has missing, repeated or unaligned minutes")


def _span(start: int, end: int) -> int:
    if start < 0 or end < start:
        raise ValueError(f"a future window needs 0 <= start <= end, not {start}..{end}")
    return end - start + 1


def future_aggregate(value: Column, start: int, end: int, how: str, order: str = "prediction_time", by: Iterable[str] = ()) -> Column:
    """mean, min or max of rows start..end ahead; null unless all are there and non-null."""
    width = _span(start, end)
    what = {"mean": F.avg, "min": F.min, "max": F.max}.get(how)
    if what is None:
        raise ValueError(f"unknown aggregation {how}")
    w = _rows(start, end, order, by)
    return F.when(F.count(value).over(w) == width, what(value).over(w))


def future_all(mask: Column, start: int, end: int, order: str = "prediction_time", by: Iterable[str] = ()) -> Column:
    """Whether every one of rows start..end ahead is there and true."""
    width = _span(start, end)
    return F.count(F.when(mask, 1)).over(_rows(start, end, order, by)) == width


def future_value(value: Column, rows: int, order: str = "prediction_time", by: Iterable[str] = ()) -> Column:
    return F.lead(value, rows).over(W.partitionBy(*by).orderBy(order))


def future_worst(value: Column, start: int, end: int, rule: str = "minimum_over_window", order: str = "prediction_time", by: Iterable[str] = ()) -> Column:
    if rule != "minimum_over_window":
        raise ValueError(f"unknown window rule {rule}")
    return future_aggregate(value, start, end, "min", order, by)


# --- labels and rows ----------------------------------------------------------------


def deadband_label(delta: Column, deadband: float, null_is_steady: bool = False) -> Column:
    """0 below -deadband, 2 above deadband, else 1; null stays null, or is 1."""
    label = F.when(delta < -deadband, 0).when(delta > deadband, 2).when(delta.isNotNull(), 1)
    return F.coalesce(label, F.lit(1)) if null_is_steady else label


def grade_class(grade: Column) -> Column:
    """Grades, rounded half to even: 1 and 2 are bad (0), 3 is middling (1), 4 and 5 are good (2)."""
    g = F.bround(grade, 0)
    return F.when(g.isin(1, 2), 0).when(g == 3, 1).when(g.isin(4, 5), 2)


def place(df: DataFrame, order: str = "prediction_time", by: Iterable[str] = (), chunk: str = "day") -> DataFrame:
    """df with __place, the position of each row in order, from 0 (of each series).

    Of one series over time the positions are counted in chunks of time, and only the chunks'
    row counts, a row for each, are added up in one place.
    """
    by = list(by)
    if by or not isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn("__place", F.row_number().over(W.partitionBy(*by).orderBy(order)) - 1)
    rows = df.withColumn("__chunk", F.date_trunc(chunk, order))
    before = W.orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("__chunk").count().select(F.col("__chunk").alias("__c"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    near = rows.withColumn("__near", F.row_number().over(W.partitionBy("__chunk").orderBy(order)) - 1)
    placed = near.join(starts, F.col("__chunk").eqNullSafe(F.col("__c")))
    return placed.withColumn("__place", F.col("__start") + F.col("__near")).drop("__chunk", "__c", "__start", "__near")


def every(df: DataFrame, k: int, order: str = "prediction_time", by: Iterable[str] = ()) -> DataFrame:
    """Every kth row in order, from the first."""
    return df if k <= 1 else place(df, order, by).where(F.col("__place") % k == 0).drop("__place")


def average_rank(value: Column, by: Iterable[str] = ()) -> Column:
    """Rank of a value; ties share the mean of their ranks."""
    return F.rank().over(W.partitionBy(*by).orderBy(value)) + (F.count(F.lit(1)).over(W.partitionBy(*by, value)) - 1) / 2


def any_known(columns: Iterable[str]) -> Column:
    return F.coalesce(*[F.col(f"`{c}`").cast("double") for c in columns]).isNotNull()


def all_known(columns: Iterable[str]) -> Column:
    held = F.lit(True)
    for c in columns:
        held = held & F.col(f"`{c}`").isNotNull()
    return held


# --- contracts ----------------------------------------------------------------------


def base_of(feature: str) -> str:
    return feature.split("__", 1)[0]


def check_features(columns: Collection[str], spec: SeriesSpec, extra: Collection[str] = ()) -> None:
    """Raise for a forbidden, unregistered or oddly derived feature; extra names are let through."""
    known = {*spec.process, *CLUSTER_COLUMNS}
    for c in columns:
        if c in extra:
            continue
        base, _, derived = c.partition("__")
        if c in spec.forbidden or base in spec.forbidden or base in spec.labels:
            raise AssertionError(f"{c} may not be a feature")
        if base not in known:
            raise AssertionError(f"{c} is no registered feature")
        if derived and not any(derived.startswith(f"{s}_") and derived.endswith("m") and derived[len(s) + 1 : -1].isdigit() for s in STATISTICS):
            raise AssertionError(f"{c} is derived in an unregistered way")


def delay_group(feature: str, groups: Mapping[str, Collection[str]]) -> str:
    base = base_of(feature)
    for name, members in groups.items():
        if base in members:
            return name
    raise KeyError(f"{feature} belongs to no delay group")
