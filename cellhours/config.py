"""Every threshold of the label and feature semantics, in one place.

A :class:`Rules` value is passed explicitly to the operators, so two builds with different
thresholds can run side by side in one session.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # The label, slot, horizon and lag definitions of the data product.
    nic_degraded_below: int = 7
    min_altitude_ft: float = 20_000.0
    min_aircraft: int = 5
    degraded_share_from: float = 0.30
    slot_minutes: int = 60
    horizon_hours: int = 6
    lag_hours: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 168)
    neighbour_lag_hours: tuple[int, ...] = (1, 3, 6)
    share_window_hours: tuple[int, ...] = (6, 24)
    count_window_hours: tuple[int, ...] = (24,)
    grid_resolution: int = 2
    positive_rate_low: float = 0.005
    positive_rate_high: float = 0.5
    max_capture_lag_minutes: int = 120
    sweep_deadline_minutes: int = 20
    stale_run_minutes: int = 60
    recent_runs_limit: int = 200
    feature_version: str = "v2-neighbours"

    def __post_init__(self) -> None:
        if self.slot_minutes <= 0 or (24 * 60) % self.slot_minutes:
            raise ValueError("slot_minutes must divide a day")
        if min((self.horizon_hours, *self.lag_hours, *self.neighbour_lag_hours)) < 1:
            raise ValueError("horizon and lags are whole hours from 1 on")

    def require_hourly(self) -> None:
        """Lags, windows and the horizon count hours, so they need slots of one hour."""
        if self.slot_minutes != 60:
            raise ValueError("features need slots of 60 minutes")

    @property
    def slot_micros(self) -> int:
        return self.slot_minutes * 60_000_000


DEFAULT_RULES = Rules()
