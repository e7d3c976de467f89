"""Composite confidence of a signal or a group."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import round_half_up


def confidence(weight: Column, classifier: Column, anomaly: Column, cfg: Config = DEFAULT) -> Column:
    """Weighted source reliability, class confidence and anomaly; missing parts count 0."""
    zero = F.lit(0.0)
    boost = F.least(F.lit(1.0) + F.coalesce(anomaly, zero), F.lit(2.0))
    value = (
        F.coalesce(weight, zero) * F.lit(cfg.weight_source)
        + F.coalesce(classifier, zero) * F.lit(cfg.weight_classifier)
        + boost * F.lit(cfg.weight_anomaly) * F.lit(0.5)
    )
    return F.least(round_half_up(value), F.lit(1.0))
