"""Parameters of the engine; every query takes them from one frozen object, folded into its plan as literals."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class EngineConfig:
    # Dates and thresholds of the decision policy.
    receipt_epoch: date = date(2026, 7, 7)
    p90_reference: date = date(2026, 6, 25)
    creation_reference: date = date(2026, 6, 29)
    shift_dead_band: int = 14
    shift_cap: int = 3650
    stale_days: int = 180
    gray_zone: tuple[int, int] = (170, 205)
    future_days: int = 30
    review_cap: float = 0.55
    bucket_prior: int = 15
    default_path_prior: float = 0.55
    weak_read_score: int = 88
    weak_flag_score: int = 85
    # Batch statistics.
    epoch_min_dates: int = 20
    epoch_min_score: int = 90
    epoch_bulk_days: int = 60
    epoch_gap_days: int = 45
    sponsor_min_cases: int = 100
    sponsor_min_score: int = 95
    sponsor_share: float = 0.004
    sponsor_floor: int = 4
    mined_min: int = 2
    # Supervision of a running batch.
    governor_up: tuple[float, ...] = (1.02, 1.12, 1.35, 1.70)
    governor_down: tuple[float, ...] = (0.95, 1.06, 1.28, 1.60)
    pace_window: int = 200
    heartbeat_stale_s: int = 150
    recycle_cases: int = 48
    retry_cap: int = 128
    # Scoring weights of decisions.
    weight_correct: int = 8
    weight_hedge: int = 2
    weight_missed: int = 1
    weight_false_approval: int = -4
    # Switches that change which rules apply; off as shipped.
    fee_prior_approval: bool = False
    corroborate_fee: bool = False
    recovered_approval: bool = False
    fusion_mode: str = "full"
    extra: dict = field(default_factory=dict)


DEFAULT = EngineConfig()
