"""What a sensor series consists of: roles of its columns, ranges, windows, delays and horizons."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

TIME_ANCHORS = ("bucket_start", "bucket_end", "prediction_time")


@dataclass(frozen=True)
class SeriesSpec:
    """Roles are tuples of column names. Ranges are inclusive; a stable minute is strictly above every limit of stable_above."""

    time: str = "time"
    chemistry: tuple[str, ...] = ()
    chemistry_ratios: tuple[str, ...] = ()
    inlet_ratios: tuple[str, ...] = ()
    process: tuple[str, ...] = ()
    grade: str = "grade"
    assay: str = "assay"
    temperature: str = "temperature"
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    stable_above: dict[str, float] = field(default_factory=dict)
    forbidden: frozenset[str] = frozenset()
    delay_groups: dict[str, frozenset[str]] = field(default_factory=dict)
    delay_candidates: dict[str, tuple[int, ...]] = field(default_factory=dict)
    by: tuple[str, ...] = ()

    @property
    def labels(self) -> tuple[str, ...]:
        return (self.grade, self.assay)

    @property
    def last_columns(self) -> tuple[str, ...]:
        """Columns of which a minute keeps its last reading."""
        return (*self.chemistry, *self.chemistry_ratios, *self.labels)

    @property
    def mean_columns(self) -> tuple[str, ...]:
        last = set(self.last_columns)
        return tuple(dict.fromkeys(c for c in (*self.inlet_ratios, *self.process) if c not in last))

    @property
    def read_columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.time, *self.by, *self.chemistry, *self.chemistry_ratios, *self.inlet_ratios, *self.process, *self.labels)))


@dataclass(frozen=True)
class RunConfig:
    """Settings of a run, in the names of its JSON file. The defaults are fixed values."""

    data_path: str
    output_dir: str
    reuse_minute_cache: bool = True
    random_seed: int = 20260915
    cluster_k_min: int = 3
    cluster_k_max: int = 6
    feature_windows_minutes: tuple[int, ...] = (10, 30, 60)
    temperature_future_start_minutes: int = 25
    temperature_future_end_minutes: int = 35
    temperature_trend_deadband_c: float = 7.0
    secondary_air_target_c: float = 1100.0
    kiln_state_horizon_minutes: int = 30
    kiln_state_label_start_minutes: int = 25
    kiln_state_label_end_minutes: int = 35
    kiln_state_window_rule: str = "minimum_over_window"
    inlet_chemistry_alignment_step_minutes: int = 30
    fcao_prediction_horizon_minutes: int = 60
    fcao_delay_candidates_minutes: dict[str, tuple[int, ...]] = field(default_factory=dict)
    fcao_trend_deadband: float = 0.05
    train_stride_minutes: int = 5
    weekly_min_train_weeks: int = 4
    pre_a2_reference_metrics_path: str | None = None
    run_manifest_path: str | None = None
    config_dir: str = "."
    cluster_restarts: int = 20
    event_purge_minutes: int | None = None


def load_spec(path: str | Path) -> SeriesSpec:
    """A plant's spec from a JSON file: a list of columns, each with its name, roles and, if it has them, range, limit and delay group.

    derived lists features that aren't columns of the source but belong to a delay group.
    """
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    columns = given["columns"]
    of = lambda role: tuple(c["name"] for c in columns if role in c["roles"])
    single = {role: found[0] for role in ("grade", "assay", "temperature") if (found := of(role))}
    groups: dict[str, set[str]] = {}
    for c in (*columns, *given.get("derived", [])):
        if "delay_group" in c:
            groups.setdefault(c["delay_group"], set()).add(c["name"])
    return SeriesSpec(
        time=given.get("time", "time"), chemistry=of("chemistry"), chemistry_ratios=of("chemistry_ratio"), inlet_ratios=of("inlet_ratio"), process=of("process"), **single,
        ranges={c["name"]: tuple(map(float, c["range"])) for c in columns if "range" in c}, stable_above={c["name"]: float(c["stable_above"]) for c in columns if "stable_above" in c},
        forbidden=frozenset(given.get("forbidden", [])), delay_groups={g: frozenset(m) for g, m in groups.items()},
        delay_candidates={g: tuple(v) for g, v in given.get("delay_candidates_minutes", {}).items()},
    )


KILN = load_spec(Path(__file__).parent / "plants" / "kiln.json")
