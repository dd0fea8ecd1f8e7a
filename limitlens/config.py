"""Parameters of a run. Thresholds are examples; tune them for each process."""

from __future__ import annotations

from dataclasses import dataclass, field

# Supported behaviour classes and the grades that are evaluated.
PATTERNS = ("PATTERN_A", "PATTERN_B", "PATTERN_C", "PATTERN_D")
GRADES = ("G1", "G2", "G3", "G4")

# Scales a median absolute deviation to the standard deviation of a normal sample.
MAD_SCALE = 1.4826

# Two-sided tail shares outside mean +/- 3 standard deviations of a normal sample.
TAIL_LOW, TAIL_HIGH = 0.00135, 0.99865


@dataclass(frozen=True)
class Settings:
    patterns: tuple[str, ...] = PATTERNS
    grades: tuple[str, ...] = GRADES
    excluded_areas: tuple[str, ...] = ()
    recent_days: int = 30
    window_days: int = 30
    current_week_days: int = 7
    prefill: bool = True
    fence_k: float = 1.5
    min_points: int = 5
    min_std: float = 0.0
    few_points_floor: int = 0
    # {pattern: (sigma limit, relative limit)}
    thresholds: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {p: (4.0, 3.5) for p in PATTERNS}
    )
    # A group with more readings than this is never handled by a single task.
    hot_rows: int = 1_000_000
    # Tool buckets of a day in a new cache (a property of the table from then on); by the size of the source if not given.
    tool_buckets: int | None = None
    # Source days that are read at the same time when they are read one by one.
    fetch_concurrency: int = 4
    # A join side is broadcast only when a count shows that it has at most this many rows.
    broadcast_rows: int = 500_000
