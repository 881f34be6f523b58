"""Config, guards, scans, sinks and provenance of files."""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import importlib.metadata
import json
import math
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.timebase import check_minutes, minute_series
from ..spec import RunConfig, SeriesSpec

_HASHED = 1 << 20  # bytes read at once


# --- config and guards ----------------------------------------------------------------


def load_config(path: str | Path) -> RunConfig:
    """A run's JSON settings. Relative data and output paths are both taken from the config's folder; unknown keys are ignored."""
    path = Path(path).resolve()
    given = json.loads(path.read_text(encoding="utf-8"))
    if "fcao_prediction_horizon_minutes" not in given and "fcao_process_delay_minutes" in given:
        given["fcao_prediction_horizon_minutes"] = given["fcao_process_delay_minutes"]
    known = {f.name for f in dataclasses.fields(RunConfig)}
    cfg = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known} | {"config_dir": str(path.parent)}
    for k in ("data_path", "output_dir", "pre_a2_reference_metrics_path", "run_manifest_path"):
        if cfg.get(k) and "://" not in cfg[k]:
            cfg[k] = str(path.parent / cfg[k])
    return RunConfig(**cfg)


def output_folder(cfg: RunConfig) -> Path:
    out = Path(cfg.output_dir)
    (out / "models").mkdir(parents=True, exist_ok=True)
    return out


def assert_output_safe(source: str | Path, output: str | Path) -> None:
    """The output may be neither the source nor below it."""
    source, output = Path(source).resolve(), Path(output).resolve()
    if output == source or source in output.parents:
        raise ValueError(f"the output {output} would write into the source {source}")


# --- scans ----------------------------------------------------------------------------


def parquet_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names, from the schema alone."""
    return spark.read.parquet(path).columns


def scan(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """The required columns of a Parquet source; raises if any is missing."""
    df = spark.read.parquet(path)
    required = list(required)
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the source lacks columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in required])


def scan_present(spark: SparkSession, path: str, optional: Iterable[str]) -> DataFrame:
    """Those of the optional columns that the source has."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in optional if c in df.columns])


def fingerprint(spark: SparkSession, path: str, spec: SeriesSpec) -> str:
    """Of a source's files (path, length, time of modification) and the spec: what a cached minute frame depends on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    of_files = files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")))), ";"), 256)).first()[0]
    return hashlib.sha256(f"{of_files}{spec}".encode()).hexdigest()


def minute_cache(spark: SparkSession, source: str, folder: str, spec: SeriesSpec, reuse: bool = True) -> DataFrame:
    """The source's minute frame, from the cache if source and spec are those it was made of, else made and written."""
    at = f"{folder}/minute_cache-{fingerprint(spark, source, spec)[:16]}.parquet"
    if reuse:
        try:
            return spark.read.parquet(at)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
    made = minute_series(spark.read.parquet(source), spec)
    made.write.mode("overwrite").parquet(at)
    out = spark.read.parquet(at)
    check_minutes(out, spec.by)
    return out


# --- sinks ----------------------------------------------------------------------------


def to_jsonable(value: Any) -> Any:
    """Rows, numpy values, times and nested containers as JSON types; NaN and infinities become null."""
    if isinstance(value, Row):
        return to_jsonable(value.asDict(recursive=True))
    if isinstance(value, Mapping):
        return {str(k): to_jsonable(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [to_jsonable(v) for v in (sorted(value, key=str) if isinstance(value, (set, frozenset)) else value)]
    if isinstance(value, np.ndarray):
        return to_jsonable(value.tolist())
    if isinstance(value, np.generic):
        return to_jsonable(value.item())
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, (dt.datetime, dt.date, Path)):
        return str(value)
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return to_jsonable(dataclasses.asdict(value))
    return value


def write_json(path: str | Path, value: Any) -> None:
    Path(path).write_text(json.dumps(to_jsonable(value), ensure_ascii=False, indent=2), encoding="utf-8")


#: Rows of a CSV file that the driver writes.
MOST_CSV_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str | Path, bom: bool = True) -> None:
    """A small frame as one CSV file with a header, nested columns as JSON; with a byte order mark for spreadsheets. Beyond MOST_CSV_ROWS rows, a folder of files."""
    flat = [F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    if df.limit(MOST_CSV_ROWS + 1).count() > MOST_CSV_ROWS:
        write_csv_files(df.select(*flat), str(path))
        return
    df.select(*flat).toPandas().to_csv(path, index=False, encoding="utf-8-sig" if bom else "utf-8")


def write_csv_files(df: DataFrame, path: str) -> None:
    """A frame of any size as a folder of CSV files with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


# --- provenance -----------------------------------------------------------------------


def sha256_file(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(_HASHED):
            digest.update(block)
    return digest.hexdigest()


def file_metadata(path: str | Path, include_hash: bool = True) -> dict:
    """Absolute path, size, time of modification and hash; of a folder, those of its files together."""
    path = Path(path).resolve()
    if path.is_dir():
        files = [file_metadata(p, include_hash) for p in sorted(path.rglob("*")) if p.is_file()]
        return {"path": str(path), "size_bytes": sum(f["size_bytes"] for f in files), "files": files}
    stat = path.stat()
    return {"path": str(path), "size_bytes": stat.st_size, "mtime_ns": stat.st_mtime_ns} | ({"sha256": sha256_file(path)} if include_hash else {})


#: Files up to this size are hashed by the executors, each as a whole.
MOST_HASHED = 1 << 30


def folder_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime, sha256) of every file below a path, hashed by the executors; null for files above MOST_HASHED."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    hashed = files.where(F.col("length") <= MOST_HASHED).select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > MOST_HASHED).select("path", "length", "modificationTime", F.lit(None).cast("string").alias("sha256"))
    return hashed.unionByName(large)


def source_metadata(spark: SparkSession, path: str) -> dict:
    """Path, size, files and hash of a source on any file system Spark reads: of one file its own hash, of several that of their names and hashes.

    A file above MOST_HASHED on a local path is hashed by the driver; elsewhere its size and time of modification stand for it.
    """
    files = [r.asDict() for r in folder_hashes(spark, path).orderBy("path").collect()]  # a row for each file
    for f in files:
        local = f["path"].removeprefix("file:")
        if f["sha256"] is None and Path(local).exists():
            f["sha256"] = sha256_file(local)
    told = [f["sha256"] or f"{f['length']}|{f['modificationTime']}" for f in files]
    whole = files[0]["sha256"] if len(files) == 1 else hashlib.sha256("\n".join(f"{f['path']}|{t}" for f, t in zip(files, told, strict=True)).encode()).hexdigest()
    return {"path": path, "size_bytes": sum(f["length"] for f in files), "sha256": whole, "files": to_jsonable(files)}


def assert_unchanged(before: dict, after: dict) -> dict:
    if before != after:
        raise RuntimeError(f"the source {before.get('path')} changed during the run")
    return {"unchanged": True, "before": before, "after": after}


def code_hashes(folder: str | Path) -> dict[str, str]:
    """Hash of every Python and JSON file of a package's folder, by its path in it."""
    folder = Path(folder)
    return {str(p.relative_to(folder)): sha256_file(p) for kind in ("*.py", "*.json") for p in sorted(folder.rglob(kind))}


def package_version(name: str) -> str | None:
    try:
        return importlib.metadata.version(name)
    except importlib.metadata.PackageNotFoundError:
        return None
