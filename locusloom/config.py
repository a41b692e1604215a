"""Parameters that change results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    phase: int = 21
    min_depth: int = 1
    max_hits: int = 25
    mismatches: int = 0
    normalise: bool = False
    norm_factor: float = 1e7
    cluster_buffer: int = 300
    unique_ratio: float = 0.2
    least_length: int = 350
    score_cutoff: float = 50.0
    least_peak: float = 12.5
    most_complexity: float = 0.3
    pooled: bool = False
    legacy: bool = False

    def __post_init__(self):
        if self.phase < 4 or self.cluster_buffer < 0 or self.max_hits < 1:
            raise ValueError("phase, cluster_buffer and max_hits are out of range")
