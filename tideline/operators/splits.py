"""Chronological splits with purge gaps, and weekly walk-forward folds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import place

TRAIN, VALIDATION = 0.7, 0.85
PARTS = ("train", "validation", "test")


def boundaries(df: DataFrame, time: str = "prediction_time") -> tuple[datetime, datetime]:
    """Times at positions floor(0.7 n) and floor(0.85 n) of the rows in order; floats are multiplied, as 0.7 is not a decimal here."""
    n = df.count()
    if not n:
        raise IndexError("no rows to split")
    spots = [min(int(n * TRAIN), n - 1), min(int(n * VALIDATION), n - 1)]
    at = {r["__place"]: r[time] for r in place(df.select(time), time).where(F.col("__place").isin(spots)).collect()}
    return at[spots[0]], at[spots[1]]


def part_of(time: str, first: Column, second: Column, purge_minutes: int) -> Column:
    """train, validation or test, null in the purge gaps before each boundary."""
    gap = F.expr(f"interval {int(purge_minutes)} minutes")
    t = F.col(time)
    return F.when(t < first - gap, "train").when((t >= first) & (t < second - gap), "validation").when(t >= second, "test")


def purged_split(df: DataFrame, purge_minutes: int, time: str = "prediction_time") -> DataFrame:
    """df with its part; the boundaries are those of its own rows."""
    first, second = boundaries(df, time)
    kind = df.schema[time].dataType
    out = df.withColumn("part", part_of(time, F.lit(first).cast(kind), F.lit(second).cast(kind), purge_minutes))
    return out.where("part is not null")


def check_split(df: DataFrame, purge_minutes: int, time: str = "prediction_time") -> None:
    """Raise unless training ends more than the purge before validation and test begin, and parts do not meet."""
    ends = {r["part"]: (r["a"], r["b"]) for r in df.groupBy("part").agg(F.min(time).alias("a"), F.max(time).alias("b")).collect()}
    if "train" in ends:
        for other in ("validation", "test"):
            if other in ends and not ends["train"][1] + timedelta(minutes=purge_minutes) < ends[other][0]:
                raise AssertionError(f"train runs into {other}")
    if "validation" in ends and "test" in ends and not ends["validation"][1] < ends["test"][0]:
        raise AssertionError("validation runs into test")


def week_of(time: str = "prediction_time") -> Column:
    """Monday of the week."""
    return F.date_trunc("week", F.col(time))


def weeks(df: DataFrame, time: str = "prediction_time") -> list[datetime]:
    """Weeks with data, in order; one small row for each is collected."""
    return [r[0] for r in df.select(week_of(time).alias("w")).where("w is not null").distinct().orderBy("w").collect()]


@dataclass(frozen=True)
class Fold:
    number: int
    week: datetime
    train_before: datetime

    def train(self, df: DataFrame, time: str = "prediction_time") -> DataFrame:
        return df.where(F.col(time).cast("timestamp") < F.lit(self.train_before))

    def test(self, df: DataFrame, time: str = "prediction_time") -> DataFrame:
        t = F.col(time).cast("timestamp")
        return df.where((t >= F.lit(self.week)) & (t < F.lit(self.week + timedelta(days=7))))


def weekly_folds(df: DataFrame, horizon_minutes: int, min_train_weeks: int, time: str = "prediction_time") -> Iterator[Fold]:
    """One fold for each week with data after the first min_train_weeks; training ends a horizon before the week."""
    for number, week in enumerate(weeks(df, time)[min_train_weeks:], start=1):
        yield Fold(number, week, week - timedelta(minutes=horizon_minutes))


def sample_summary(df: DataFrame, target: str, stride: int = 1, categorical: bool = False, time: str = "prediction_time") -> dict:
    """Rows, span, rows after a stride, and a histogram or the range of the target."""
    y = F.col(f"`{target}`")
    r = df.agg(F.count("*").alias("rows"), F.min(time).alias("start"), F.max(time).alias("end"), F.count(y).alias("known"), F.min(y).alias("min"), F.max(y).alias("max"), F.avg(y).alias("mean")).first()
    out = {"rows": r["rows"], "start": str(r["start"]) if r["start"] else None, "end": str(r["end"]) if r["end"] else None, "rows_after_stride": -(-r["rows"] // stride)}
    if categorical:
        counts = df.where(y.isNotNull()).groupBy(y.cast("int").alias("y")).count().orderBy("y").collect()
        return out | {"labels": {str(c["y"]): c["count"] for c in counts}}
    return out | {"target_nonnull": r["known"], "target_min": r["min"], "target_max": r["max"], "target_mean": r["mean"]}
