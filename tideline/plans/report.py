"""The static report and the manifest of a run."""

from __future__ import annotations

import html
import json
import platform
import sys
import time
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from ..sources.io import code_hashes, file_metadata, package_version, to_jsonable, write_json

_STYLE = "body{font-family:sans-serif;margin:2rem auto;max-width:64rem;color:#222}table{border-collapse:collapse;width:100%}th,td{text-align:left;border-bottom:1px solid #ddd;padding:.4rem}.cards{display:flex;flex-wrap:wrap;gap:.6rem}.card{border:1px solid #ddd;padding:.6rem;min-width:10rem}.card b{display:block}"


def metric_cards(section: Mapping[str, Any]) -> str:
    """A card for each number; floats to four places, nothing for nested values."""
    shown = [(k, f"{v:.4f}" if isinstance(v, float) else str(v)) for k, v in section.items() if isinstance(v, (int, float))]
    return "".join(f'<div class="card">{html.escape(str(k))}<b>{html.escape(v)}</b></div>' for k, v in shown)


def _table(rows: Mapping[str, Any]) -> str:
    text = lambda v: json.dumps(to_jsonable(v), ensure_ascii=False) if isinstance(v, (dict, list)) else str(v)
    return "<table>" + "".join(f"<tr><th>{html.escape(str(k))}</th><td>{html.escape(text(v))}</td></tr>" for k, v in rows.items()) + "</table>"


def write_html(path: str | Path, metrics: Mapping[str, Any], signal: Mapping[str, Any], summary: Mapping[str, Any]) -> None:
    """One escaped page without scripts: the signal, the data, and the scores of each task."""
    tasks = "".join(f'<h3>{html.escape(str(k))}</h3><div class="cards">{metric_cards(v)}</div>' for k, v in metrics.items() if isinstance(v, Mapping))
    body = f"<h1>Forecast report</h1><p>Offline and advisory: nothing here is sent to a plant.</p><h2>Signal</h2>{_table(signal)}<h2>Data</h2>{_table(summary)}<h2>Scores on later data</h2>{tasks}"
    Path(path).write_text(f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>Forecast report</title><style>{_STYLE}</style></head><body>{body}</body></html>', encoding="utf-8")


def write_manifest(path: str | Path, config_path: str | Path, output: str | Path, started: float, **sections: Any) -> dict:
    """Environment, config, hashes of the package's code and of the files the run wrote (its output folder alone), and the given sections."""
    path, output = Path(path).resolve(), Path(output)
    made = [file_metadata(p) for p in sorted(output.rglob("*")) if p.is_file() and p.resolve() != path]
    manifest = {
        "started_at_epoch": started, "completed_at_epoch": time.time(), "runtime_seconds": time.time() - started, "command": sys.argv, "config": file_metadata(config_path),
        "environment": {"python": sys.version, "platform": platform.platform(), "packages": {p: package_version(p) for p in ("pyspark", "numpy", "pandas", "pyarrow")}},
        "code": code_hashes(Path(__file__).parents[1]), "generated_files": made, **sections,
    }
    write_json(path, manifest)
    return manifest
