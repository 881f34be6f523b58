"""The minute series of a stream: a minute comes out once its watermark has passed, so never before it is over."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_minutes(stream: DataFrame, mean: Iterable[str], last: Iterable[str], time: str = "time", by: Iterable[str] = (), late: str = "2 minutes") -> DataFrame:
    """Means and last non-null readings of each minute of a streaming frame, with anchors; later rows than the watermark are dropped."""
    rows = stream.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", late)
    means = [F.avg(f"`{c}`").alias(c) for c in mean]
    lasts = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("__at"))).alias(c) for c in last]
    names = [*mean, *last]
    out = rows.groupBy(*by, F.window("__at", "1 minute").alias("w")).agg(*means, *lasts)
    return out.select(*by, F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"), F.col("w.end").alias("prediction_time"), *[F.col(f"`{c}`") for c in names])
