"""Settings that define the meaning of results; passed explicitly to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# Allowed labels, weights and thresholds of the signal model.
CATEGORIES = (
    "Authentication Failure",
    "Network Outage",
    "Deployment Failure",
    "Performance Degradation",
    "Security Breach",
)
SOURCE_WEIGHTS = {"alert": 1.0, "ticket": 0.8, "log": 0.6}
REQUIRED_COLUMNS = (
    "signal_id",
    "source_type",
    "category",
    "text",
    "timestamp",
    "incident_group",
)


@dataclass(frozen=True)
class Config:
    categories: tuple[str, ...] = CATEGORIES
    source_weights: dict[str, float] = field(default_factory=lambda: dict(SOURCE_WEIGHTS))
    max_features: int = 3000
    max_ngram: int = 2
    test_fraction: float = 0.2
    similarity_threshold: float = 0.25
    window_minutes: int = 30
    z_threshold: float = 2.0
    z_clip: float = 3.0
    off_hours_factor: float = 1.3
    business_hours: tuple[int, int] = (8, 17)
    weight_source: float = 0.3
    weight_classifier: float = 0.4
    weight_anomaly: float = 0.3

    @property
    def window_micros(self) -> int:
        return self.window_minutes * 60_000_000


DEFAULT = Config()
