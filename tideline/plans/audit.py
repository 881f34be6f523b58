"""Exploratory audits: lags between two places of a plant, and what the source's labels derive from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import correlation, fisher_columns, with_ranks
from ..operators.events import lagged_pairs
from ..operators.timebase import forward_fill_chunked
from ..sources.io import scan_present
from ..spec import SeriesSpec

GRADE_LOG = r"等级\s*(\d+)"


def lag_scan(minute: DataFrame, pairs: Mapping[str, tuple[str, str]], lags: Iterable[int], order: str = "prediction_time", by: Iterable[str] = ()) -> DataFrame:
    """Pearson's r with its Fisher interval and Spearman's r of every pair of columns at every lag, over forward-filled rows.

    (component, lag_minutes, overlap_rows, overlap_start, overlap_end, pearson_r, ci95_low, ci95_high, spearman_r). The
    interval takes rows as independent and is too narrow for a serially correlated series.
    """
    lags, out = list(lags), None
    names = sorted({c for p in pairs.values() for c in p})
    filled = forward_fill_chunked(minute, names, order, by)
    for component, (early, late) in pairs.items():
        rows = lagged_pairs(filled, early, late, lags, order, by).withColumn("component", F.lit(component))
        out = rows if out is None else out.unionByName(rows)
    ranked = with_ranks(out, ["x", "y"], ["component", "lag"])
    some = F.count("*") >= 3
    got = ranked.groupBy("component", F.col("lag").alias("lag_minutes")).agg(
        F.count("*").alias("overlap_rows"), F.min(order).alias("overlap_start"), F.max(order).alias("overlap_end"),
        F.when(some, correlation(F.col("x"), F.col("y"))).alias("pearson_r"), F.when(some, correlation(F.col("rank_x"), F.col("rank_y"))).alias("spearman_r"),
    )
    low, high = fisher_columns(F.col("pearson_r"), F.col("overlap_rows"))
    return got.withColumns({"ci95_low": low, "ci95_high": high})


def peaks(scan: DataFrame) -> DataFrame:
    """The lag of the largest absolute r of each component, the first of equals."""
    best = F.max_by(F.struct("lag_minutes", "pearson_r", "ci95_low", "ci95_high", "overlap_rows"), F.struct(F.abs("pearson_r"), -F.col("lag_minutes")))
    return scan.where("pearson_r is not null").groupBy("component").agg(best.alias("b")).select("component", "b.*")


def audit_inlet(minute: DataFrame, spec: SeriesSpec, step_minutes: int = 30) -> tuple[DataFrame, dict]:
    pairs = {a[-2:]: (a, b) for a, b in zip(spec.chemistry_ratios, spec.inlet_ratios, strict=True)}
    lags = list(range(0, 721, step_minutes))
    scan = lag_scan(minute, pairs, lags, by=spec.by).persist()
    found = {r["component"]: r.asDict() for r in peaks(scan).collect()}
    return scan, {"status": "exploratory_only_not_used_to_set_residence_time", "candidate_lags_minutes": lags, "fill_for_audit": "causal_ffill_only", "peaks_by_component": {c: found.get(c) for c in pairs}}


def equality_counts(df: DataFrame, a: str, b: str) -> dict[str, int]:
    both = F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()
    same = F.col(f"`{a}`") == F.col(f"`{b}`")
    return df.agg(F.count_if(both).alias("common_nonnull"), F.count_if(both & same).alias("equal"), F.count_if(both & ~same).alias("mismatch")).first().asDict()


def logged_grade(column: str):
    """The grade a log text names, or null."""
    return F.expr(f"try_cast(regexp_extract(`{column}`, r'{GRADE_LOG}', 1) AS DOUBLE)")


def audit_source(spark: SparkSession, path: str, spec: SeriesSpec, second: str = "窑况等级_1", log: str = "窑况日志") -> dict:
    """Which forbidden fields a source has, and how often the label equals the log's grade or its own copy; the conclusion follows the counts."""
    df = scan_present(spark, path, (spec.grade, second, log))
    present = sorted(set(spark.read.parquet(path).columns) & spec.forbidden)
    none = {"common_nonnull": 0, "equal": 0, "mismatch": 0}
    has = set(df.columns)
    logged = equality_counts(df.select(F.col(f"`{spec.grade}`").alias("a"), logged_grade(log).alias("b")), "a", "b") if {spec.grade, log} <= has else none
    copied = equality_counts(df, spec.grade, second) if {spec.grade, second} <= has else none
    n, same = logged["common_nonnull"], logged["equal"]
    said = "no rows have both a label and a logged grade" if not n else f"{same} of {n} logged grades equal the label" + ("; the label may be a copy of the log" if same == n else "")
    return {"forbidden_source_fields_present": present, "excluded_from_base_features": sorted(spec.forbidden), "label_log_comparison": logged, "label_copy_comparison": copied, "interpretation": said}
