"""Scores and correlations as aggregates, safe where a plain division would raise."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import average_rank


def correlation(x: Column, y: Column) -> Column:
    """Pearson's r of pairs where both are known; null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)))


def with_ranks(df: DataFrame, columns: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    return df.withColumns({f"rank_{c}": average_rank(F.col(c), by) for c in columns})


def fisher_interval(r: float | None, n: int) -> list[float] | None:
    """95 % interval of a correlation by Fisher's z; none for n <= 3, |r| >= 1 or no number."""
    if r is None or n <= 3 or not math.isfinite(r) or abs(r) >= 1:
        return None
    z, half = math.atanh(r), 1.96 / math.sqrt(n - 3)
    return [math.tanh(z - half), math.tanh(z + half)]


def fisher_columns(r: Column, n: Column) -> tuple[Column, Column]:
    half = F.lit(1.96) / F.sqrt(n - 3)
    ok = (n > 3) & (F.abs(r) < 1)
    return F.when(ok, F.tanh(F.atanh(r) - half)), F.when(ok, F.tanh(F.atanh(r) + half))


def regression_scores(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mae, rmse and r2 over finite pairs; r2 is null for a constant truth."""
    t, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    ok = t.isNotNull() & p.isNotNull() & ~F.isnan(t) & ~F.isnan(p) & (F.abs(t) != float("inf")) & (F.abs(p) != float("inf"))
    e = F.when(ok, t - p)
    spread = F.var_pop(F.when(ok, t))
    return df.groupBy(*by).agg(F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.when(spread > 0, 1 - F.avg(e * e) / F.nullif(spread, F.lit(0.0))).alias("r2"))


def confusion(df: DataFrame, truth: str, predicted: str, labels: Sequence[int]) -> DataFrame:
    """(truth, predicted, n) for every pair of labels, zeros included."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(int(a), int(b)) for a in labels for b in labels], "truth int, predicted int")
    counts = df.groupBy(F.col(truth).cast("int").alias("truth"), F.col(predicted).cast("int").alias("predicted")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def classification_scores(df: DataFrame, truth: str, predicted: str, labels: Sequence[int], risk: int | None = None) -> dict:
    """macro_f1 over the fixed labels (0 where undefined), balanced accuracy over labels that occur, the matrix, and the risk label's recall."""
    n = {(r["truth"], r["predicted"]): r["n"] for r in confusion(df, truth, predicted, labels).collect()}
    matrix = [[n[(a, b)] for b in labels] for a in labels]
    hit = [matrix[i][i] for i in range(len(labels))]
    true, said = [sum(row) for row in matrix], [sum(col) for col in zip(*matrix, strict=True)]
    f1 = [2 * h / (t + s) if t + s else 0.0 for h, t, s in zip(hit, true, said, strict=True)]
    recall = [h / t for h, t in zip(hit, true, strict=True) if t]
    out = {"macro_f1": sum(f1) / len(labels), "balanced_accuracy": sum(recall) / len(recall) if recall else None, "confusion_matrix": matrix, "labels": list(labels)}
    if risk is not None:
        i = list(labels).index(risk)
        out["risk_class_recall"] = hit[i] / true[i] if true[i] else 0.0
    return out


def macro_f1(counts: DataFrame, labels: int) -> DataFrame:
    """macro_f1 of a confusion table (truth, predicted, n) over a number of labels, as one row."""
    hits = F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("h")
    rows = counts.groupBy(F.col("truth").alias("l")).agg(hits, F.sum("n").alias("t"))
    cols = counts.groupBy(F.col("predicted").alias("l")).agg(F.sum("n").alias("s"))
    f1 = F.when(F.col("t") + F.col("s") > 0, 2 * F.col("h") / F.nullif(F.col("t") + F.col("s"), F.lit(0))).otherwise(0.0)
    return rows.join(cols, "l").agg((F.sum(f1) / labels).alias("macro_f1"))
