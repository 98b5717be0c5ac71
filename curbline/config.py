"""Every tunable number in one place."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Thresholds:
    # fixed values: plausibility limits of a single measurement
    max_speed_mph: float = 100.0
    max_distance_mi: float = 300.0
    max_duration_min: float = 480.0
    # fixed values: budgets of a monthly run
    max_reject_ratio: float = 0.05
    max_reversal_ratio: float = 0.08
    max_volume_delta: float = 0.40
    max_null_ratio_distance: float = 0.10
    max_null_ratio_duration: float = 0.05
    # fixed values: source watching
    lookback_months: int = 6
    source_stale_days: int = 120

    def limits(self) -> dict[str, float]:
        """The limits a run was judged by; stored with the run."""
        return {k: float(v) for k, v in asdict(self).items() if k.startswith("max_")}
